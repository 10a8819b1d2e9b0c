"""Incremental reads as Structured Streaming with state tables.

Each micro-batch is folded into a versioned state table; the batch number is stored
with the rows, so a batch that runs again after a failure changes nothing.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from siltworks.sources.state import StateTable


def newest(batch: DataFrame, key: str, order: list[str]) -> DataFrame:
    w = Window.partitionBy(key).orderBy(*(F.desc(c) for c in order))
    return batch.withColumn("__n", F.row_number().over(w)).where("__n = 1").drop("__n")


def fold_into(state: StateTable, key: str, order: list[str]) -> Callable[[DataFrame, int], None]:
    """A foreachBatch handler: the newest row of each key wins over the state's if it is later."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        done = StateTable(spark, f"{state.path}-batches", "batch long", ["batch"])
        if not done.read().where(F.col("batch") == batch_id).isEmpty():
            return
        held = state.read()
        merged = newest(held.unionByName(batch.select(*held.columns)), key, order)
        state.commit(merged, state.version())
        done.insert_new(spark.range(batch_id, batch_id + 1).select(F.col("id").alias("batch")))

    return handle


def run_available(spark: SparkSession, path: str, schema: str, state: StateTable, key: str, order: list[str], checkpoint: str, files_per_batch: int = 1) -> None:
    """Read what files have come and stop: a scheduled run of the pipeline."""
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(path)
    query = stream.writeStream.foreachBatch(fold_into(state, key, order)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()


def windowed_counts(stream: DataFrame, time: str, key: str, lateness: str, window: str) -> DataFrame:
    """Rows by window and key; rows later than ``lateness`` are not waited for."""
    return stream.withWatermark(time, lateness).groupBy(F.window(time, window), key).agg(F.count("*").alias("n"))


def advance_watermark(last: DataFrame, scan: DataFrame, time: str, complete: bool) -> DataFrame:
    """One row: the watermark after a scan. It moves only if the scan was complete."""
    seen = scan.agg(F.max(time).alias("__seen"))
    both = last.select(F.col("watermark")).crossJoin(F.broadcast(seen))  # one row on either side
    moved = F.greatest("watermark", "__seen") if complete else F.col("watermark")
    return both.select(moved.alias("watermark"))


def drain(pending: DataFrame, receipts: DataFrame, failed: DataFrame, key: str, seq: str) -> DataFrame:
    """What an outbox may deliver now: the first pending row of each key that has no failure and is not delivered yet."""
    todo = pending.join(receipts.select(key, "version"), [key, "version"], "left_anti").join(failed.select(key).distinct(), key, "left_anti")
    w = Window.partitionBy(key).orderBy(seq)
    return todo.withColumn("__n", F.row_number().over(w)).where("__n = 1").drop("__n")
