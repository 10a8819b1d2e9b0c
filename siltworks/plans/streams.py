"""Queries that run a stream or keep state over several steps."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from siltworks.plans.registry import query, table
from siltworks.sources import budgeted
from siltworks.sources.state import StateTable, shared_root
from siltworks.streaming import delivery, incremental


def work_folder(spark, name: str) -> str:
    root = shared_root(spark)
    return f"{root.rstrip('/')}/siltworks/{name}-{uuid.uuid4().hex}"


@query("""SELECT user_id, event_id, event_type FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS k FROM events) WHERE k = 1""")
def stream_upsert_state(spark, sf_dir):
    """Events as a file stream, folded into a state of the newest event of each user."""
    folder = work_folder(spark, "upsert")
    events = table(spark, sf_dir, "events").select("user_id", "event_id", "event_type", "ts")
    events.repartition(3, "event_id").write.parquet(f"{folder}/in")
    schema = "user_id long, event_id long, event_type string, ts timestamp_ntz"
    state = StateTable(spark, f"{folder}/state", schema, ["user_id"])
    incremental.run_available(spark, f"{folder}/in", schema, state, "user_id", ["ts", "event_id"], f"{folder}/checkpoint", files_per_batch=2)
    return state.read().select("user_id", "event_id", "event_type")


@query("""WITH v AS (SELECT doc_id, md5(text) AS version FROM documents) SELECT doc_id, version, doc_id % 2 = 0 AS baseline FROM v""")
def baseline_then_changes(spark, sf_dir):
    """Inventory after two scans: the first sets the baseline, the second adds to it."""
    docs = table(spark, sf_dir, "documents").select("doc_id", F.md5("text").alias("version"))
    state = StateTable(spark, work_folder(spark, "inventory"), "doc_id long, version string, baseline boolean", ["doc_id"])
    state.insert_new(docs.where("doc_id % 2 = 0").withColumn("baseline", F.lit(True)))
    state.insert_new(docs.withColumn("baseline", F.lit(False)))
    return state.read()


@query("""SELECT source, min(doc_id) AS doc_id FROM documents WHERE doc_id % 3 <> 0 AND source NOT IN (SELECT source FROM documents WHERE doc_id % 97 = 5) GROUP BY source""")
def outbox_drain(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("source", "doc_id", F.col("doc_id").alias("version"))
    due = incremental.drain(docs, docs.where("doc_id % 3 = 0"), docs.where("doc_id % 97 = 5"), "source", "doc_id")
    return due.select("source", "doc_id")


@query("SELECT event_type, strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M:%S') AS hour, count(*) AS n FROM events GROUP BY 1, 2")
def hourly_windows(spark, sf_dir):
    counted = table(spark, sf_dir, "events").groupBy(F.window("ts", "1 hour").alias("w"), "event_type").agg(F.count("*").alias("n"))
    return counted.select("event_type", F.date_format("w.start", "yyyy-MM-dd HH:mm:ss").alias("hour"), "n")


def wiki_sink(ident: str, version: str, attempt: int) -> str | None:
    return "transport_uncertain" if int(version) % 7 == 3 and attempt == 1 else None


def notes_sink(ident: str, version: str, attempt: int) -> str | None:
    return "managed_content_modified" if int(version) % 11 == 5 else None


@query("""WITH e AS (SELECT user_id, event_id, event_id % 11 = 5 AS stuck, sum((event_id % 7 = 3)::INT) OVER (PARTITION BY user_id ORDER BY event_id) AS lost, event_id % 7 = 3 AS flaky,
  lag(event_id) OVER (PARTITION BY user_id ORDER BY event_id) AS before FROM events),
s AS (SELECT user_id, min(event_id) AS stop FROM e WHERE stuck OR (flaky AND lost = 3) GROUP BY user_id),
x AS (SELECT s.user_id, stop, flaky AND lost = 3 AS at_first, before FROM s JOIN e ON e.user_id = s.user_id AND event_id = stop)
SELECT e.user_id::VARCHAR AS id, CASE WHEN max(stop) IS NULL THEN max(event_id) WHEN bool_or(at_first) THEN max(x.before) ELSE max(stop) END::VARCHAR AS wiki,
  CASE WHEN max(stop) IS NULL THEN max(event_id) ELSE max(x.before) END::VARCHAR AS notes, count(*) FILTER (WHERE event_id >= stop) AS waiting,
  CASE WHEN max(stop) IS NOT NULL THEN CASE WHEN bool_or(at_first) THEN 'wiki' ELSE 'notes' END END AS held_by FROM e LEFT JOIN x ON x.user_id = e.user_id GROUP BY e.user_id""")
def two_sink_delivery(spark, sf_dir):
    """Each user's events to two sinks in order, in three runs: the first sink fails some once, the second some for good."""
    folder = work_folder(spark, "delivery")
    inbox, log, checkpoint = (f"{folder}/{x}" for x in ("in", "log", "checkpoint"))
    events = table(spark, sf_dir, "events").select(F.col("user_id").cast("string").alias("id"), F.col("event_id").cast("string").alias("version"), F.col("event_id").alias("seq"))
    events.write.parquet(inbox)
    for _ in range(2):
        delivery.deliver_available(spark, inbox, log, checkpoint, ("wiki", wiki_sink), ("notes", notes_sink))
        delivery.wake_held(spark, log, inbox)
    delivery.deliver_available(spark, inbox, log, checkpoint, ("wiki", wiki_sink), ("notes", notes_sink))
    tried = delivery.read_log(spark, log)
    acknowledged = delivery.receipts(tried).groupBy("id").pivot("sink", ["wiki", "notes"]).agg(F.first("version"))
    waiting = delivery.pending(events, tried, "notes").groupBy("id").agg(F.count("*").alias("waiting"))
    stuck = delivery.held(tried).select("id", F.col("sink").alias("held_by"))
    whole = events.select("id").distinct().join(acknowledged, "id", "left").join(waiting, "id", "left").join(stuck, "id", "left")
    return whole.select("id", "wiki", "notes", F.coalesce("waiting", F.lit(0)).alias("waiting"), "held_by")


@query("""WITH n AS (SELECT count(*) AS n FROM events), p AS (SELECT event_id * 12 // n AS page, count(*) AS rows FROM events, n GROUP BY 1)
SELECT 'page=' || lpad(page::VARCHAR, 2, '0') AS page, CASE WHEN page = 11 THEN 3 ELSE 1 END AS times, rows FROM p WHERE page <= 5 OR page = 11""")
def budgeted_scan(spark, sf_dir):
    """Three runs of a scan over twelve pages of events: each reads the newest page and as many after the cursor as its rows admit."""
    folder = work_folder(spark, "budgeted")
    events = table(spark, sf_dir, "events").select("event_id", "event_type", "value")
    n = events.count()
    events.repartition("event_id").withColumn("page", F.lpad(F.floor(F.col("event_id") * 12 / n).cast("string"), 2, "0")).write.partitionBy("page").parquet(f"{folder}/pages")
    for _ in range(3):
        budgeted.run_budgeted(spark, f"{folder}/pages", "event_id long, event_type string, value double", f"{folder}/out", f"{folder}/checkpoint", rows=3 * -(-n // 12), newest=1)
    read = spark.read.schema(f"event_id long, event_type string, value double, {budgeted.ADDED}").parquet(f"{folder}/out")
    return read.groupBy("page").agg(F.countDistinct("run").alias("times"), F.countDistinct("event_id").alias("rows"))
