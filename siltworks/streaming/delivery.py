"""Ordered delivery of versions to two sinks, as a stateful stream.

Versions of one id go out in order, each to the first sink and then to the second.
The second gets a version only once the first has acknowledged it; a failure holds
that version and the later ones of its id, and no other id. Acknowledgements are
state, so a run that starts again delivers nothing twice and goes on where the last
one stopped: only the stage that failed is tried again.

State is kept for each id with Spark's state store, as one value: the queue of
versions that are not delivered, the last version each sink acknowledged, and what is held.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

#: A row without a version wakes its id: what is held is tried again.
INBOX = "id string, version string, seq long"
LOG = "id string, version string, seq long, sink string, outcome string, reason string, attempt int, batch_step int"
#: What is known of an id: the last number queued, its steps, what each sink acknowledged, what is held, and the queue.
STATE = "seq long, steps int, first string, second string, held_version string, held_sink string, attempts int, versions array<string>, seqs array<long>"
#: sink(id, version, attempt) -> None if it was written and read back, else the reason why not.
Sink = Callable[[str, str, int], str | None]


class Outbox(StatefulProcessor):
    """The state of one id; see the module."""

    def __init__(self, sinks: tuple[tuple[str, Sink], tuple[str, Sink]], paused: Callable[[str], bool], versions_a_step: int | None):
        self.sinks, self.paused, self.limit = sinks, paused, versions_a_step

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("outbox", STATE)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:  # noqa: N802, N803
        """State is read and written once for an id and batch, not for each version: every access is a round trip to the JVM."""
        ident = key[0]
        seq, steps, first, second, *held, versions, seqs = self.state.get() or (None, 0, None, None, None, None, 0, [], [])
        receipts, held = [first, second], tuple(held) if held[0] is not None else None
        waiting = list(zip(versions, seqs, strict=True))
        for row in sorted(((r.version, r.seq) for r in rows if r.version is not None), key=lambda r: r[1]):
            # numbers only grow: what was queued before, delivered or not, is not queued again
            if seq is None or row[1] > seq:
                waiting.append(row)
                seq = row[1]
        steps += 1
        tried, done, out = 0, 0, []
        while done < len(waiting) and not self.paused(ident) and (self.limit is None or tried < self.limit):
            tried += 1
            held, entries = self.deliver(ident, *waiting[done], steps, receipts, held)
            out += entries
            if held is not None:
                break
            done += 1
        rest = waiting[done:]
        self.state.update((seq, steps, *receipts, *(held or (None, None, 0)), [v for v, _ in rest], [n for _, n in rest]))
        yield from out

    def deliver(self, ident: str, version: str, seq: int, step: int, receipts: list[str | None], held: tuple | None) -> tuple[tuple | None, list[Row]]:
        """Take one version through the stages that it has not passed; returns what is held now, and the attempts."""
        out = []
        for at, (name, sink) in enumerate(self.sinks):
            again = held is not None and held[:2] == (version, name)
            if at == 0 and receipts[0] == version and not again:
                continue
            attempt = held[2] + 1 if again else 1
            reason = sink(ident, version, attempt)
            out.append(Row(id=ident, version=version, seq=seq, sink=name, outcome="held" if reason else "verified", reason=reason, attempt=attempt, batch_step=step))
            if reason:
                return (version, name, attempt), out
            receipts[at] = version
            if again:
                held = None
        return None, out


@contextmanager
def rocks(spark: SparkSession):
    """The state store that keyed state of several kinds needs, for the streams started inside."""
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name)
    spark.conf.set(name, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def deliver_available(
    spark: SparkSession, inbox: str, log: str, checkpoint: str, first: tuple[str, Sink], second: tuple[str, Sink], paused: Callable[[str], bool] = lambda ident: False,
    versions_a_step: int | None = None, files_a_batch: int = 1000,
) -> None:
    """Deliver what has come to ``inbox`` (Parquet rows :data:`INBOX`) and stop.

    Each attempt is a row of ``log``, written once by Spark's file sink. Versions
    that are paused or beyond ``versions_a_step`` of an id stay in its queue until
    the id's next row. Sinks must take a version that they have as a success: a
    task that is lost after a write runs again.
    """
    rows = spark.readStream.schema(INBOX).option("maxFilesPerTrigger", files_a_batch).parquet(inbox)
    made = rows.where("id is not null").groupBy("id").transformWithState(Outbox((first, second), paused, versions_a_step), LOG, "Append", "None")
    with rocks(spark):
        run = made.writeStream.format("parquet").option("path", log).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
        run.awaitTermination()


def read_log(spark: SparkSession, log: str) -> DataFrame:
    return spark.read.schema(LOG).parquet(log)


def wake_held(spark: SparkSession, log: str, inbox: str) -> None:
    """Put a wake row into the inbox for each id whose last attempt was held."""
    order = F.struct("batch_step", "seq", (F.col("outcome") == "held").cast("int"))
    last = read_log(spark, log).groupBy("id").agg(F.max_by("outcome", order).alias("outcome"))
    held = last.where("outcome = 'held'").select("id", F.lit(None).cast("string").alias("version"), F.lit(None).cast("long").alias("seq"))
    held.write.mode("append").parquet(inbox)


def receipts(log: DataFrame) -> DataFrame:
    """Rows (id, sink, version, seq): the last version each sink acknowledged."""
    newest = F.max_by(F.struct("version", "seq"), F.struct("seq", "batch_step")).alias("r")
    return log.where("outcome = 'verified'").groupBy("id", "sink").agg(newest).select("id", "sink", "r.version", "r.seq")


def pending(inbox: DataFrame, log: DataFrame, second: str) -> DataFrame:
    """Rows (id, version, seq) that the second sink has not acknowledged."""
    done = log.where((F.col("sink") == second) & (F.col("outcome") == "verified")).select("id", "seq").distinct()
    return inbox.where("version is not null").dropDuplicates(["id", "seq"]).join(done, ["id", "seq"], "left_anti")


def held(log: DataFrame) -> DataFrame:
    """Rows (id, sink, version, reason, attempt): what is held now, the newest attempt of each id if that failed."""
    w = Window.partitionBy("id").orderBy(F.desc("batch_step"), F.desc("seq"), F.desc(F.col("outcome") == "held"))
    return log.withColumn("__n", F.row_number().over(w)).where("__n = 1 and outcome = 'held'").select("id", "sink", "version", "reason", "attempt")
