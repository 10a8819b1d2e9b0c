"""Packing documents into token sequences along a space-filling curve.

Each document's hashed word vector is projected to four dimensions, the
projections become a Hilbert key, and documents are range-sorted by that key, so
that neighbours on the curve are alike. Every range is one stream of ids that is
cut at the sequence length; what is left at its end is cut into powers of two,
so no sequence needs padding.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltworks.llm.shared import keep
from siltworks.llm.tokens import read_text, token_batches, with_end

#: Buckets of the hashed vector, dimensions of the curve, bits of each dimension.
BUCKETS, DIMENSIONS, BITS = 512, 4, 8
#: Shards are numbered in the upper bits of sequence_id.
SHARD_BITS = 36

PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def projection() -> np.ndarray:
    """Fixed random signs, one column per dimension."""
    return np.random.default_rng(20240229).choice([-1.0, 1.0], (BUCKETS, DIMENSIONS))


def hilbert_keys(cells: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Distance along the Hilbert curve of each grid cell, one row per cell (Skilling's transpose form)."""
    x = cells.T.astype(np.int64)
    n = len(x)
    bit = 1 << (bits - 1)
    while bit > 1:
        low = bit - 1
        for i in range(n):
            turned = x[i] & bit > 0
            swap = np.where(turned, 0, (x[0] ^ x[i]) & low)
            x[0] ^= np.where(turned, low, swap)
            x[i] ^= swap
        bit >>= 1
    for i in range(1, n):
        x[i] ^= x[i - 1]
    flip, bit = np.zeros_like(x[0]), 1 << (bits - 1)
    while bit > 1:
        flip ^= np.where(x[n - 1] & bit, bit - 1, 0)
        bit >>= 1
    key = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for i in range(n):
            key = key << 1 | (x[i] ^ flip) >> b & 1
    return key


def curve_keys(ids: np.ndarray, counts: np.ndarray, signs: np.ndarray) -> np.ndarray:
    """The Hilbert key of each document by its ids; documents without ids get the curve's middle cell."""
    bucket = (ids * np.uint32(2654435761)) >> np.uint32(23)
    ends, keys = np.cumsum(counts), [np.empty(0, np.int64)]
    for at in range(0, len(counts), 1024):
        of = counts[at : at + 1024]
        here = bucket[ends[at] - of[0] : ends[at + len(of) - 1]]
        found = np.bincount(np.repeat(np.arange(len(of)), of) * BUCKETS + here, minlength=len(of) * BUCKETS).reshape(-1, BUCKETS)
        # square roots of counts have the square root of the number of ids as their norm
        to = np.sqrt(found) @ signs / np.sqrt(np.maximum(of, 1))[:, None]
        keys.append(hilbert_keys(np.clip(np.floor((np.tanh(to) + 1) / 2 * (1 << BITS)), 0, (1 << BITS) - 1)))
    return np.concatenate(keys)


def powers(n: int) -> list[int]:
    """``n`` as a sum of powers of two, largest first."""
    return [1 << b for b in range(n.bit_length() - 1, -1, -1) if n >> b & 1]


def pack(docs: DataFrame, tokenizer: str, length: int = 2048, end_id: int = 1, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """One row per piece of a document in a sequence of at most ``length`` ids.

    ``length`` is a power of two. A document is its ids by the tokenizers library
    and ``end_id``; a null or empty text is ``end_id`` alone. Each id lies in one
    piece. Sequences are gapless: all have ``length`` ids but those at a shard's
    end, whose lengths are smaller powers of two. Rows with equal or null ids are
    documents of their own. ``with_ids`` adds the piece's ids as a binary column.
    """
    spec = docs.sparkSession.sparkContext.broadcast(read_text(tokenizer))

    def tokenize(batches):
        signs = projection()
        for doc_ids, ids, counts in token_batches(batches, spec.value):
            keys = pa.array(curve_keys(ids, counts, signs))
            yield pa.RecordBatch.from_arrays([doc_ids, keys, *with_end(ids, counts, end_id)], ["doc_id", "curve", "width", "ids"])

    def cut(batches):
        shard = TaskContext.get().partitionId() << SHARD_BITS
        sequence, fill, waiting, out = 0, 0, [], []
        names = [x.split(" ")[0] for x in schema.split(", ")]

        def piece(doc, start, ids, total, at):
            raw = ids.astype("<u4").tobytes()
            return (doc, start, len(ids), zlib.crc32(raw), total, shard + sequence, at) + ((raw,) if with_ids else ())

        def batch(rows):
            return pa.RecordBatch.from_arrays([pa.array(c, pa.binary() if n == "ids" else pa.int64()) for n, c in zip(names, zip(*rows, strict=True), strict=True)], names)

        # ``waiting`` holds the ids of the open sequence: it may be the last and then is cut anew
        for b in batches:
            for doc, width, raw in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2), strict=True):
                ids = np.frombuffer(raw.as_buffer(), "<u4" if width == 4 else "<u2")
                at = 0
                while at < len(ids):
                    take = min(length - fill, len(ids) - at)
                    waiting.append((doc, at, ids[at : at + take], len(ids)))
                    fill, at = fill + take, at + take
                    if fill == length:
                        offset = 0
                        for d, s, part, total in waiting:
                            out.append(piece(d, s, part, total, offset))
                            offset += len(part)
                        sequence, fill, waiting = sequence + 1, 0, []
                if len(out) >= 2000:
                    yield batch(out)
                    out = []
            waiting = [(d, s, part.copy(), total) for d, s, part, total in waiting]
        for size in powers(fill):
            offset = 0
            while offset < size:
                d, s, part, total = waiting.pop(0)
                take = min(size - offset, len(part))
                out.append(piece(d, s, part[:take], total, offset))
                offset += take
                if take < len(part):
                    waiting.insert(0, (d, s + take, part[take:], total))
            sequence += 1
        if out:
            yield batch(out)

    schema = PIECES + (", ids binary" if with_ids else "")
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    # written once: range boundaries are sampled from it, and tokens are not made twice
    tokens = keep(source.mapInArrow(tokenize, "doc_id long, curve long, width int, ids binary"), "pack-tokens")
    # the id splits ties, so that equal documents need not share a range
    ordered = tokens.repartitionByRange("curve", "doc_id").sortWithinPartitions("curve", "doc_id")
    return ordered.select("doc_id", "width", "ids").mapInArrow(cut, schema)
