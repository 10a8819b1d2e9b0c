"""Token ids from the tokenizers library, one call for each distinct white-space separated chunk of some texts."""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: White space that tokenizer patterns have beside ASCII's.
OTHER_SPACE = r"[\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
#: The pattern of word-end BPE files that split letters, single digits and other characters (fixed value),
#: and the characters for which its classes are known: Latin ones, not < (special tokens) nor İ (whose lower case is two).
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
LATIN = re.compile("[!-;=-~¡-įı-ſ]*\\Z")
LATIN_CHUNK = "^[!-;=-~¡-įı-ſ]*$"
#: Marks that end a word: a run of them is one word of the pattern.
MARKS = "!\"#$%&'()*+,-./:;=>?@[\\]^_`{|}~"
#: Words that are encoded as one line; bytes of text that are handled at once (a longer text alone).
WORDS_A_LINE, SLICE_BYTES = 20_000, 8 << 20


def spelled_bytes() -> dict[int, int]:
    """Code point of the printable character that stands for a byte over 127 in byte-level vocabularies -> the byte."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in printable]
    return {256 + i: b for i, b in enumerate(rest) if b > 127} | {b: b for b in printable if b > 127}


def read_text(path: str) -> str:
    """A tokenizer file, read on the driver; workers get it as a broadcast (bounded by the vocabulary)."""
    with open(path, encoding="utf-8") as f:
        return f.read()


def slices(batch: pa.RecordBatch, column: int, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in stretches of rows with at most ``limit`` bytes in one column, or of one row."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < batch.num_rows:
        before = ends[at - 1] if at else 0
        end = max(at + 1, int(np.searchsorted(ends, before + limit, side="right")))
        yield batch.slice(at, end - at)
        at = end
    # workers live on: give back what Arrow set aside for this batch
    pa.default_memory_pool().release_unused()


def distinct_chunks(texts: pa.Array, ascii_only: bool = False) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Distinct chunks of some texts, the code of each chunk in order, and how many chunks each text has.

    ``ascii_only``: other white space than ASCII's does not separate. Some chunks are empty.
    """
    if not ascii_only and pc.any(pc.match_substring_regex(texts, OTHER_SPACE)).as_py():
        texts = pc.replace_substring_regex(texts, OTHER_SPACE, " ")
    split = pc.ascii_split_whitespace(texts)
    counts = pc.fill_null(pc.list_value_length(split), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    coded = split.flatten().dictionary_encode()
    return coded.dictionary, coded.indices.to_numpy(), counts


def gather(flat: np.ndarray, starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The stretches of ``flat`` with these starts and counts, one after the other."""
    ends = np.cumsum(counts)
    total = int(ends[-1]) if len(ends) else 0
    kind = np.int32 if max(total, len(flat)) < 1 << 31 else np.int64
    at = np.arange(total, dtype=kind)
    at += np.repeat((starts - ends + counts).astype(kind), counts)
    return flat[at]


def joined(strings: pa.Array, by: str) -> str:
    return pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(strings)], pa.int32()), strings), by)[0].as_py()


def starts_of(counts: np.ndarray) -> np.ndarray:
    return np.cumsum(counts) - counts


class TextIds:
    """Ids of whole texts from those of their parts; nothing is remembered from call to call.

    Where the tokenizer drops white space (``by_chunk``), a text's ids are those
    of its chunks one after the other, so each distinct chunk of the texts is
    encoded once and numpy puts the ids together. Where it also lower-cases and
    splits words from other characters (``by_word``), a chunk of Latin characters
    has the ids of its lower-case form, and the marks behind a word have their
    own, so ``Word,`` and ``word`` are one. A subclass encodes the parts.
    """

    by_chunk = by_word = False

    def _ids(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of some strings, and how many each has."""
        raise TypeError("a subclass encodes strings")

    def _words(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The same for lower-case words of Latin letters."""
        return self._ids(words.to_pylist())

    def _chunks(self, chunks: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The same for chunks."""
        if not self.by_word:
            return self._ids(chunks.to_pylist())
        simple = pc.match_substring_regex(chunks, LATIN_CHUNK)
        chunks = pc.if_else(simple, pc.utf8_lower(chunks), chunks)
        plain = pc.and_(simple, pc.utf8_is_alpha(chunks))
        rest = pc.invert(plain)
        words, marks, of_letters = [], [], []
        other = joined(chunks.filter(rest), "\n").split("\n") if pc.any(rest).as_py() else []
        for chunk, latin in zip(other, simple.filter(rest).to_numpy(zero_copy_only=False).tolist(), strict=True):
            word = chunk.rstrip(MARKS) if latin else chunk
            if not word[-1:].isalnum():
                word = chunk
            words.append(word)
            marks.append(chunk[len(word) :])
            of_letters.append(latin and word.isalpha())
        # the parts of a chunk are a word and marks, which may be empty
        coded = pa.concat_arrays([chunks.filter(plain), pa.array([*words, *marks, ""], pa.string())]).dictionary_encode()
        parts, code = coded.dictionary, coded.indices.to_numpy()
        plain, n, m = plain.to_numpy(zero_copy_only=False), len(chunks) - len(words), len(words)
        two = np.full((len(chunks), 2), code[-1])
        two[plain, 0], two[~plain, 0], two[~plain, 1] = code[:n], code[n : n + m], code[n + m : -1]
        letters = np.zeros(len(parts), bool)
        letters[code[:n]] = True
        letters[code[n : n + m][np.array(of_letters, bool)]] = True
        found, other = self._words(parts.filter(pa.array(letters))), self._ids(parts.filter(pa.array(~letters)).to_pylist())
        counts, starts = np.empty(len(parts), np.int64), np.empty(len(parts), np.int64)
        counts[letters], counts[~letters] = found[1], other[1]
        starts[letters], starts[~letters] = starts_of(found[1]), len(found[0]) + starts_of(other[1])
        return gather(np.concatenate([found[0], other[0]]), starts[two.ravel()], counts[two.ravel()]), counts[two].sum(axis=1)

    def encode_batch(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of some texts, and how many each has; null: none."""
        if not self.by_chunk:
            return self._ids(pc.fill_null(texts, "").to_pylist())
        chunks, codes, in_text = distinct_chunks(texts)
        ids, counts = self._chunks(chunks)
        of_chunk = counts[codes]
        total = np.concatenate([[0], np.cumsum(of_chunk)])
        ends = np.cumsum(in_text)
        return gather(ids, starts_of(counts)[codes], of_chunk), total[ends] - total[ends - in_text]


class LibraryIds(TextIds):
    """Ids by the tokenizers library; words of letters are encoded in lines and told apart by the ids that end a word."""

    def __init__(self, spec: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(spec)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        one = lambda x: self.tokenizer.encode(x, add_special_tokens=False).ids
        parsed = json.loads(spec)
        splits = [p["pattern"]["Regex"] for p in (parsed.get("pre_tokenizer") or {}).get("pretokenizers", []) if p["type"] == "Split"]
        suffix = parsed["model"].get("end_of_word_suffix") or ""
        self.by_chunk = one(" a \nb1,c ") == one("a") + one("b1,c")
        self.by_word = self.by_chunk and bool(suffix) and splits == [WORDS] and one("aÀſ1") == one("AÀſ1") == one("aàſ1")
        if self.by_word:
            self.ends = np.zeros(self.tokenizer.get_vocab_size(), bool)
            self.ends[[i for s, i in parsed["model"]["vocab"].items() if s.endswith(suffix)]] = True
            # the model alone, for lines of lower-case words whose bytes are spelled already
            bare = {**parsed, "normalizer": None, "pre_tokenizer": {"type": "WhitespaceSplit"}, "added_tokens": [], "post_processor": None}
            self.model = Tokenizer.from_str(json.dumps(bare))
            self.spelling = np.arange(256, dtype="<u4")
            for code, byte in spelled_bytes().items():
                self.spelling[byte] = code

    def _ids(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        found = [e.ids for at in range(0, len(texts), 256) for e in self.tokenizer.encode_batch_fast(texts[at : at + 256], add_special_tokens=False)]
        counts = np.fromiter(map(len, found), np.int64, len(found))
        return np.fromiter((i for x in found for i in x), np.uint32, int(counts.sum())), counts

    def _words(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        ids, counts = [np.empty(0, np.uint32)], [np.empty(0, np.int64)]
        for at in range(0, len(words), WORDS_A_LINE):
            part = words.slice(at, WORDS_A_LINE)
            line = joined(part, " ")
            if not line.isascii():
                line = self.spelling[np.frombuffer(line.encode(), np.uint8)].tobytes().decode("utf-32-le")
            found = np.array(self.model.encode_batch_fast([line], add_special_tokens=False)[0].ids, np.uint32)
            ends = np.flatnonzero(self.ends[found]) + 1
            more = (found, np.diff(ends, prepend=0)) if len(ends) == len(part) else self._ids(part.to_pylist())
            ids.append(more[0])
            counts.append(more[1])
        return np.concatenate(ids), np.concatenate(counts)

_LOADED: dict[int, LibraryIds] = {}


def library(spec: str) -> LibraryIds:
    """One tokenizer per worker process."""
    key = hash(spec)
    if key not in _LOADED:
        _LOADED.clear()
        _LOADED[key] = LibraryIds(spec)
    return _LOADED[key]


def with_end(ids: np.ndarray, counts: np.ndarray, end_id: int) -> tuple[pa.Array, pa.Array]:
    """Width of an id in bytes, and each text's ids and ``end_id`` as little-endian integers of that width."""
    width = 2 if max(int(ids.max(initial=0)), end_id) < 1 << 16 else 4
    ends = np.cumsum(counts + 1)
    flat = np.empty(len(ids) + len(counts), f"<u{width}")
    flat[ends - 1] = end_id
    inner = np.ones(len(flat), bool)
    inner[ends - 1] = False
    flat[inner] = ids
    # a slice holds less than 2 GB of text and a character has an id at most, so offsets fit unless one text is longer
    offsets = np.concatenate([[0], ends * width])
    kind, text_type = (np.int32, pa.binary()) if offsets[-1] < 1 << 31 else (np.int64, pa.large_binary())
    return pa.array(np.full(len(counts), width, np.int32)), pa.Array.from_buffers(text_type, len(counts), [None, pa.py_buffer(offsets.astype(kind)), pa.py_buffer(flat)])


def token_batches(batches, spec: str):
    """For Arrow batches (id, text): the id column, all ids (numpy uint32) and how many each row has."""
    encode = library(spec).encode_batch
    for batch in batches:
        for part in slices(batch, 1):
            yield part.column(0), *encode(part.column(1))
