"""BPE encoding and decoding with a tokenization automaton.

The merges are compiled one after the other. The automaton starts with one
state that loops on every base symbol. Merge k, ``u v -> w``, puts in one
gadget: all transitions on ``u`` go to a copy of their old target that lacks
``v``, and each state that has a transition on ``u`` gets one on ``w`` to where
``v`` led. So all transitions on a symbol lead to one state, that of the symbol,
and a state is its ancestor's state less the symbols cut since. That keeps the
automaton as small as the merge list: :class:`Automaton` stores the time of each
gadget and the lineage of each symbol's state, and fills a transition table with
the entries that words ask for. A token sequence is a correct tokenization if
and only if the automaton accepts it, and each prefix of a word has exactly one,
so a word is encoded left to right with the state of each prefix.

Decoding emits the label of each id's arc.
"""

from __future__ import annotations

import hashlib
import json
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from siltworks.llm.tokens import LATIN, WORDS, TextIds, joined, read_text, slices

#: Entries of the transition table that a worker holds before it is emptied (some 20 MB); bounds memory, not results.
MEMO = 200_000

#: The classes of that pattern over Latin characters in lower case.
LATIN_WORDS = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-zªµºß-öø-ſ]+|[0-9²³¹¼½¾]|[^\\sa-zªµºß-öø-ſ0-9²³¹¼½¾]+")


class Automaton:
    """Deterministic automaton over the symbols of a merge list."""

    def __init__(self, symbols: dict[str, int], merges: list[tuple[str, str]], suffix: str):
        #: Words are spelled with one character per base symbol: bytes, and bytes at a word's end.
        spelled: dict[str, str] = {}
        for char, byte in byte_symbols().items():
            spelled[char] = chr(byte)
            if suffix:
                spelled[char + suffix] = chr(256 + byte)
        self.ids = {spelled[s]: symbols[s] for s in spelled if s in symbols}
        size = max(symbols.values()) + 1
        self.left, self.right, self.birth = [-1] * size, [-1] * size, [-1] * size
        self.gadget: dict[tuple[int, int], int] = {}
        self.table: dict[int, bool] = {}
        dead = set()
        for k, (u, v) in enumerate(merges):
            if u + v not in symbols:
                continue
            a, b, w = symbols[u], symbols[v], symbols[u + v]
            if a in dead or b in dead or (a, b) in self.gadget or not self._has(a, b, k - 1):
                # no state reaches this pair any more, so the merged symbol never comes about
                if spelled.get(u + v) not in self.ids:
                    dead.add(w)
                continue
            self.gadget[a, b] = k
            self.left[w], self.right[w], self.birth[w] = a, b, k
            spelled[u + v] = spelled[u] + spelled[v]
            self.ids[spelled[u + v]] = w
        self.longest = max(map(len, self.ids), default=1)

    def _has(self, a: int, b: int, time: int) -> bool:
        """Whether the state of symbol ``a`` had a transition on ``b`` after gadget ``time``."""
        birth, left, right, gadget = self.birth, self.left, self.right, self.gadget
        while True:
            while birth[a] > time:
                a = right[a]
            while True:
                cut = gadget.get((a, b))
                if cut is not None and birth[b] < cut <= time:
                    return False
                if birth[a] <= birth[b] or birth[a] < 0:
                    break
                time, a = birth[a] - 1, right[a]
            if birth[b] < 0:
                return True
            time, b = birth[b], left[b]

    def step(self, a: int, b: int) -> bool:
        """The transition table: may ``b`` follow ``a``."""
        at = a << 32 | b
        found = self.table.get(at)
        if found is None:
            if len(self.table) >= MEMO:
                self.table.clear()
            found = self.table[at] = self._has(a, b, 1 << 60)
        return found

    def word(self, spelled: str) -> list[int]:
        """The ids of one pre-split word.

        Takes the longest arc that the state accepts and backs up where a path
        ends; a position that led nowhere is not tried again from the same state.
        """
        n, ids, step, longest = len(spelled), self.ids, self.step, self.longest
        whole = ids.get(spelled) if n <= longest else None
        if whole is not None:
            return [whole]
        path: list[int] = []
        ends: list[int] = []
        dead: set[tuple[int, int]] = set()
        at, end = 0, min(n, longest)
        while at < n:
            before = path[-1] if path else -1
            while end > at:
                token = ids.get(spelled[at:end])
                if token is not None and (before < 0 or step(before, token)) and (end, token) not in dead:
                    break
                end -= 1
            if end > at:
                path.append(token)
                ends.append(at)
                at = end
                end = min(n, at + longest)
            else:
                if not path:
                    raise ValueError(f"no tokenization of {spelled!r}")
                dead.add((at, path.pop()))
                end, at = at - 1, ends.pop()
        return path


def byte_symbols() -> dict[str, int]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(rest)}


class Codec(TextIds):
    """Encoder and decoder of one tokenizer file of the kind word-end BPE over bytes, which drops white space."""

    by_chunk = True

    def __init__(self, text: str):
        spec = json.loads(text)
        model = spec["model"]
        suffix = model.get("end_of_word_suffix") or ""
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.automaton = Automaton(model["vocab"], merges, suffix)
        self.shift = 256 if suffix else 0
        whole = Tokenizer.from_str(text)
        patterns = [p["pattern"]["Regex"] for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split"]
        #: Chunks of Latin characters are split here, as the library does; others by the library itself.
        self.latin = LATIN if patterns == [WORDS] and any(x["type"] == "Lowercase" for x in spec["normalizer"].get("normalizers", [])) else None
        self.normalize, self.split = whole.normalizer.normalize_str, whole.pre_tokenizer.pre_tokenize_str
        self.bytes = {ord(c): b for c, b in byte_symbols().items()}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.special_at = re.compile("|".join(map(re.escape, self.special))) if self.special else None
        arcs = {i: s for s, i in model["vocab"].items()} | {i: s for s, i in self.special.items()}
        self.labels = pa.array([arcs.get(i, "") for i in range(max(arcs) + 1)], pa.string())
        self.by_word = self.latin is not None and bool(suffix)

    def _plain(self, text: str) -> list[int]:
        out: list[int] = []
        if self.latin and self.latin.match(text):
            words = [x.encode().decode("latin-1") for x in LATIN_WORDS.findall(text.lower())]
        else:
            words = [x.translate(self.bytes) for x, _ in self.split(self.normalize(text))]
        for word in words:
            out += self.automaton.word(word[:-1] + chr(ord(word[-1]) + self.shift))
        return out

    def _chunk(self, chunk: str) -> list[int]:
        if not self.special_at or not self.special_at.search(chunk):
            return self._plain(chunk)
        out, at = [], 0
        for m in self.special_at.finditer(chunk):
            out += [*self._plain(chunk[at : m.start()]), self.special[m[0]]]
            at = m.end()
        return out + self._plain(chunk[at:])

    def _ids(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        found = [self._chunk(x) for x in texts]
        return np.fromiter((i for x in found for i in x), np.uint32), np.fromiter(map(len, found), np.int64, len(found))

    def _words(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        word, shift, out, counts = self.automaton.word, self.shift, [], []
        # bytes as characters, the last one of the kind that ends a word
        for x in joined(words, "\n").encode().decode("latin-1").split("\n") if len(words) else []:
            path = word(x[:-1] + chr(ord(x[-1]) + shift))
            out += path
            counts.append(len(path))
        return np.array(out, np.uint32), np.array(counts, np.int64)

    def decode_batch(self, ids: np.ndarray, counts: np.ndarray) -> pa.Array:
        """The arc labels of each text's ids, with a space between."""
        offsets = pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32))
        return pc.binary_join(pa.ListArray.from_arrays(offsets, self.labels.take(pa.array(ids.astype(np.int32)))), " ")


_CODECS: dict[int, Codec] = {}


def codec(text: str) -> Codec:
    """One codec per worker process and tokenizer."""
    key = hash(text)
    if key not in _CODECS:
        _CODECS[key] = Codec(text)
    return _CODECS[key]


def encode_documents(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (doc_id, ids): each whole text's ids as little-endian unsigned 32-bit integers.

    A null text counts as empty and has no ids. Repeated rows and null ids give a
    row each. Other columns of ``docs`` are not read.
    """
    spec = docs.sparkSession.sparkContext.broadcast(read_text(tokenizer))

    def run(batches):
        encode = codec(spec.value).encode_batch
        for batch in batches:
            for part in slices(batch, 1):
                raw = pa.array(bytes_of(*encode(part.column(1))), pa.binary())
                yield pa.RecordBatch.from_arrays([part.column(0), raw], ["doc_id", "ids"])

    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return source.mapInArrow(run, "doc_id long, ids binary")


def bytes_of(ids: np.ndarray, counts: np.ndarray) -> list[bytes]:
    """Each text's ids as little-endian unsigned 32-bit integers."""
    raw, ends = ids.astype("<u4").tobytes(), (4 * np.cumsum(counts)).tolist()
    return [raw[a:b] for a, b in zip([0, *ends], ends)]


def decode_documents(encoded: DataFrame, tokenizer: str) -> DataFrame:
    """Rows (doc_id, text) from rows (doc_id, ids); null ids decode to an empty text."""
    spec = encoded.sparkSession.sparkContext.broadcast(read_text(tokenizer))

    def run(batches):
        decode = codec(spec.value).decode_batch
        for batch in batches:
            for part in slices(batch, 1):
                raw = [x or b"" for x in part.column(1).to_pylist()]
                text = decode(np.frombuffer(b"".join(raw), "<u4"), np.array(list(map(len, raw)), np.int64) // 4)
                yield pa.RecordBatch.from_arrays([part.column(0), text], ["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")


def round_trip(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode, then decode what was encoded; one digest row per document.

    Columns doc_id, n_tokens, ids_sha256, decoded_sha256. One pass, no shuffle:
    ids and decoded text stay inside the task that made them.
    """
    spec = docs.sparkSession.sparkContext.broadcast(read_text(tokenizer))

    def run(batches):
        both, sha = codec(spec.value), lambda x: hashlib.sha256(x).hexdigest()
        for batch in batches:
            for part in slices(batch, 1):
                ids, counts = both.encode_batch(part.column(1))
                text = [sha(memoryview(x.as_buffer())) for x in both.decode_batch(ids, counts)]
                digests = [pa.array(map(sha, bytes_of(ids, counts)), pa.string()), pa.array(text, pa.string())]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(counts), *digests], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return source.mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
