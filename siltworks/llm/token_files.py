"""Token ids as binary files: frequency-ranked, byte-aligned, with separate control bytes.

An id is stored as its frequency rank, so frequent ids take one byte. A block
holds the documents of one stretch of doc_id order: two bits per rank give its
length in bytes (four ranks to a control byte), all control bytes stand before
all data bytes, and a block's document lengths stand in its header. Blocks are
rows of Parquet files, so Spark's commit protocol makes the writes safe.
Reading looks up byte masks by control byte and gathers with numpy.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from siltworks.llm.shared import keep, shared_folder
from siltworks.llm.tokens import read_text, token_batches, with_end

#: Ids after which a block is closed; a document is never split.
BLOCK_IDS = 1 << 16


def encode_ranks(ranks: np.ndarray) -> tuple[bytes, bytes]:
    """Control bytes and data bytes of unsigned 32-bit numbers."""
    ranks = ranks.astype("<u4")
    extra = (ranks > 0xFF).astype(np.uint8) + (ranks > 0xFFFF) + (ranks > 0xFFFFFF)
    four = np.zeros(-(-len(ranks) // 4) * 4, np.uint8)
    four[: len(ranks)] = extra
    control = four.reshape(-1, 4) @ np.array([1, 4, 16, 64], np.uint8)
    used = np.arange(4) <= extra[:, None]
    return control.astype(np.uint8).tobytes(), ranks.view(np.uint8).reshape(-1, 4)[used].tobytes()


def decoding_table() -> np.ndarray:
    """Control byte -> which of 16 output bytes the data bytes fill."""
    code = np.arange(256)[:, None] >> np.array([0, 2, 4, 6]) & 3
    return (np.arange(4) <= code[:, :, None]).reshape(256, 16)


def decode_ranks(control: bytes, data: bytes, n: int, table: np.ndarray) -> np.ndarray:
    mask = table[np.frombuffer(control, np.uint8)].reshape(-1)[: 4 * n]
    out = np.zeros(4 * n, np.uint8)
    out[mask] = np.frombuffer(data, np.uint8)
    return out.view("<u4")


def write_tokens(docs: DataFrame, tokenizer: str, path: str, end_id: int = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode whole texts, append ``end_id`` to each, write them by ascending doc_id.

    A null text counts as empty. Rows with equal ids are documents of their own,
    in any order among themselves; null ids come first. Returns the rank table
    (id, rank), which has a row for each id of the corpus and is stored beside
    the blocks in ``path``/ranks.
    """
    spark = docs.sparkSession
    spec = spark.sparkContext.broadcast(read_text(tokenizer))

    def tokenize(batches):
        for doc_ids, ids, counts in token_batches(batches, spec.value):
            yield pa.RecordBatch.from_arrays([doc_ids, *with_end(ids, counts, end_id)], ["doc_id", "width", "ids"])

    def count(batches):
        total = np.zeros(1, np.int64)
        for b in batches:
            for width, raw in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                found = np.bincount(np.frombuffer(raw.as_buffer(), "<u4" if width == 4 else "<u2"))
                if len(found) > len(total):
                    found[: len(total)] += total
                    total = found
                else:
                    total[: len(found)] += found
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(total[at], pa.int64())], ["id", "n"])

    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    tokens = keep(source.mapInArrow(tokenize, "doc_id long, width int, ids binary"), "file-tokens")
    counts = tokens.select("width", "ids").mapInArrow(count, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))
    # one row per id of the vocabulary at most, whatever the corpus
    ranked = [r["id"] for r in counts.orderBy(F.desc("n"), "id").collect()]
    ranks = spark.createDataFrame([(i, r) for r, i in enumerate(ranked)], "id long, rank long")
    ranks.coalesce(1).write.mode("overwrite").parquet(f"{path}/ranks")
    by_id = np.zeros(max(ranked, default=0) + 1, np.uint32)
    by_id[ranked] = np.arange(len(ranked), dtype=np.uint32)
    by_id = spark.sparkContext.broadcast(by_id)

    def blocks(batches):
        names = ["shard", "block", "n_ids", "doc_ids", "doc_lengths", "control", "data"]
        shard, block, held, doc_ids, size = TaskContext.get().partitionId(), 0, [], [], 0

        def close():
            lengths = np.array([len(x) for x in held], "<u4")
            control, data = encode_ranks(by_id.value[np.concatenate(held)])
            row = [shard, block, int(lengths.sum()), doc_ids, lengths.tobytes(), control, data]
            types = [pa.int32(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.binary(), pa.binary(), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, types, strict=True)], names)

        for b in batches:
            for doc, width, raw in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2), strict=True):
                held.append(np.frombuffer(raw.as_buffer(), "<u4" if width == 4 else "<u2").copy())
                doc_ids.append(doc)
                size += len(held[-1])
                if size >= BLOCK_IDS:
                    yield close()
                    block, held, doc_ids, size = block + 1, [], [], 0
        if held:
            yield close()

    ordered = tokens.repartitionByRange("doc_id").sortWithinPartitions("doc_id")
    ordered.mapInArrow(blocks, "shard int, block long, n_ids long, doc_ids array<long>, doc_lengths binary, control binary, data binary").write.mode("overwrite").parquet(f"{path}/blocks")
    return ranks


def read_tokens(spark: SparkSession, path: str, with_ids: bool = True) -> DataFrame:
    """Rows of the files' documents: doc_id, start, n_tokens, ids_crc32 and, if asked for, ids.

    ``start`` counts the ids of all documents before it. ``ids`` and the crc are
    over little-endian unsigned 32-bit ids.
    """
    ranked = [r["id"] for r in spark.read.schema("id long, rank long").parquet(f"{path}/ranks").orderBy("rank").collect()]
    ids_of = spark.sparkContext.broadcast(np.array(ranked or [0], "<u4"))
    stored = spark.read.schema("shard int, block long, n_ids long, doc_ids array<long>, doc_lengths binary, control binary, data binary").parquet(f"{path}/blocks")
    # shards are as many as the write's partitions; blocks inside one shard add up in their own window
    shards = stored.groupBy("shard").agg(F.sum("n_ids").alias("n"))
    before = shards.select("shard", (F.sum("n").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1))).alias("shard_start"))
    inside = Window.partitionBy("shard").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = stored.select("shard", "block", "n_ids").withColumn("inside", F.sum("n_ids").over(inside)).join(before, "shard")
    starts = starts.select("shard", "block", (F.coalesce("shard_start", F.lit(0)) + F.coalesce("inside", F.lit(0))).cast("long").alias("start"))
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long" + (", ids binary" if with_ids else "")

    def decode(batches):
        table, ids_by_rank = decoding_table(), ids_of.value
        for b in batches:
            for start, doc_ids, lengths, control, data in zip(*(c.to_pylist() for c in b.columns), strict=True):
                lengths = np.frombuffer(lengths, "<u4")
                ids = ids_by_rank[decode_ranks(control, data, int(lengths.sum()), table)]
                ends = np.cumsum(lengths, dtype=np.int64)
                parts = [ids[e - n : e].tobytes() for e, n in zip(ends, lengths, strict=True)]
                columns = [pa.array(doc_ids, pa.int64()), pa.array(start + ends - lengths, pa.int64()), pa.array(lengths, pa.int64()), pa.array(map(zlib.crc32, parts), pa.int64())]
                names = ["doc_id", "start", "n_tokens", "ids_crc32"]
                if with_ids:
                    columns.append(pa.array(parts, pa.binary()))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(columns, names)

    joined = stored.drop("n_ids").join(F.broadcast(starts) if starts.count() <= 200_000 else starts, ["shard", "block"])
    return joined.select("start", "doc_ids", "doc_lengths", "control", "data").mapInArrow(decode, schema)


def new_path(spark: SparkSession, name: str) -> str:
    import uuid

    return f"{shared_folder(spark)}/siltworks/{name}-{uuid.uuid4().hex}"
