"""Audit queries: candidates, freshness, evidence, coverage."""

from __future__ import annotations

from pyspark.sql import functions as F

from siltworks.functions.dates import freshness
from siltworks.operators import ranking
from siltworks.plans.registry import query, table

TARGET, WINDOW_DAYS, CAP = "2024-01-15", 3, 80
CANDIDATE_SQL = """SELECT event_type AS source, event_id, CAST(ts AS DATE) AS day, CASE WHEN event_type = 'error' THEN 'high' WHEN event_type IN ('purchase', 'signup') THEN 'medium' ELSE 'normal' END AS priority
FROM events WHERE ts >= TIMESTAMP '2024-01-13' AND ts < TIMESTAMP '2024-01-16'"""


def candidates(spark, sf_dir, target=TARGET, window_days=WINDOW_DAYS):
    """Events of the days up to ``target``; the time range reaches the Parquet scan."""
    low, high = (F.expr(f"timestamp_ntz'{target}' + interval {d} days") for d in (1 - window_days, 1))
    events = table(spark, sf_dir, "events").where((F.col("ts") >= low) & (F.col("ts") < high))
    priority = F.when(F.col("event_type") == "error", "high").when(F.col("event_type").isin("purchase", "signup"), "medium").otherwise("normal")
    return events.select(F.col("event_type").alias("source"), "event_id", F.to_date("ts").alias("day"), priority.alias("priority"))


@query(f"""SELECT source, event_id, strftime(day, '%Y-%m-%d') AS evidence_date, priority, rank FROM (SELECT *, row_number() OVER (PARTITION BY source ORDER BY priority <> 'high', day, event_id) AS rank FROM ({CANDIDATE_SQL})) WHERE rank <= {CAP}""")
def incremental_candidates(spark, sf_dir):
    """The oldest candidates of each source up to a cap, high priority first."""
    top = ranking.top_per_group(candidates(spark, sf_dir), ["source"], [F.col("priority") != "high", F.col("day"), F.col("event_id")], CAP)
    return top.select("source", "event_id", F.date_format("day", "yyyy-MM-dd").alias("evidence_date"), "priority", "rank")


@query(f"SELECT source, count(*) AS before_cap, least(count(*), {CAP}) AS after_cap, count(*) FILTER (WHERE priority = 'high') AS high FROM ({CANDIDATE_SQL}) GROUP BY source")
def candidate_counts(spark, sf_dir):
    return candidates(spark, sf_dir).groupBy("source").agg(F.count("*").alias("before_cap"), F.least(F.count("*"), F.lit(CAP)).alias("after_cap"), F.count_if(F.col("priority") == "high").alias("high"))


NOW = "2024-01-31 00:00:00"
FRESH_SQL = f"""SELECT user_id, max(ts) AS seen, CASE user_id % 4 WHEN 0 THEN 24.0 WHEN 1 THEN 240.0 WHEN 2 THEN -1.0 END AS max_hours FROM events GROUP BY user_id"""
STATUS_SQL = f"""CASE WHEN seen IS NULL THEN 'unknown' WHEN epoch(TIMESTAMP '{NOW}') - epoch(seen) < -300 THEN 'future' WHEN max_hours IS NULL THEN 'no_limit' WHEN max_hours <= 0 THEN 'invalid_limit' WHEN epoch(TIMESTAMP '{NOW}') - epoch(seen) > max_hours * 3600 THEN 'stale' ELSE 'fresh' END"""


def arrivals(spark, sf_dir):
    k = F.col("user_id") % 4
    latest = table(spark, sf_dir, "events").groupBy("user_id").agg(F.max("ts").alias("at"), F.count("*").alias("n"))
    return latest.withColumn("max_hours", F.when(k == 0, 24.0).when(k == 1, 240.0).when(k == 2, -1.0)).withColumn("status", freshness(F.col("at"), F.expr(f"timestamp_ntz'{NOW}'"), F.col("max_hours")))


@query(f"SELECT user_id, {STATUS_SQL} AS status FROM ({FRESH_SQL})")
def freshness_status(spark, sf_dir):
    return arrivals(spark, sf_dir).select("user_id", "status")


@query(f"""WITH a AS (SELECT user_id, {STATUS_SQL} AS status, (SELECT count(*) FROM events e WHERE e.user_id = f.user_id) AS n FROM ({FRESH_SQL}) f),
g AS (SELECT user_id, list_sort(list_filter([CASE WHEN status = 'stale' THEN 'stale' END, CASE WHEN status = 'invalid_limit' THEN 'bad_limit' END, CASE WHEN n < 5 THEN 'few' END, CASE WHEN status = 'no_limit' THEN 'no_policy' END], lambda x: x IS NOT NULL)) AS issues FROM a)
SELECT user_id, array_to_string(issues, ',') AS issues, CAST(len(issues) AS BIGINT) AS n_issues, CASE WHEN list_contains(issues, 'stale') OR list_contains(issues, 'bad_limit') THEN 'blocked' WHEN len(issues) > 0 THEN 'gaps' ELSE 'clear' END AS severity FROM g""")
def evidence_guard(spark, sf_dir):
    """The issues of each source, sorted, and how severe they are."""
    issue = lambda cond, name: F.when(cond, name)
    status = F.col("status")
    issues = F.array_sort(F.array_compact(F.array(issue(status == "stale", "stale"), issue(status == "invalid_limit", "bad_limit"), issue(F.col("n") < 5, "few"), issue(status == "no_limit", "no_policy"))))
    rows = arrivals(spark, sf_dir).select("user_id", issues.alias("issues"))
    severe = F.array_contains("issues", "stale") | F.array_contains("issues", "bad_limit")
    severity = F.when(severe, "blocked").when(F.size("issues") > 0, "gaps").otherwise("clear")
    return rows.select("user_id", F.array_join("issues", ",").alias("issues"), F.size("issues").cast("long").alias("n_issues"), severity.alias("severity"))


@query("""WITH r AS (SELECT 'src' || i AS source FROM range(0, 24) t(i)), d AS (SELECT source, count(*) AS n FROM documents GROUP BY source)
SELECT coalesce(r.source, d.source) AS source, CASE WHEN d.source IS NULL THEN 'missing' WHEN r.source IS NULL THEN 'unregistered' ELSE 'present' END AS status, coalesce(n, 0) AS n FROM r FULL JOIN d ON r.source = d.source""")
def source_discovery(spark, sf_dir):
    """Registered sources against those that exist."""
    registry = spark.range(24).select(F.concat(F.lit("src"), F.col("id").cast("string")).alias("source"), F.lit(True).alias("known"))
    found = table(spark, sf_dir, "documents").groupBy("source").agg(F.count("*").alias("n"))
    status = F.when(F.col("n").isNull(), "missing").when(F.col("known").isNull(), "unregistered").otherwise("present")
    return registry.join(found, "source", "full").select("source", status.alias("status"), F.coalesce("n", F.lit(0)).alias("n"))


@query("""SELECT source, count(*) AS n, round(100.0 * count(*) FILTER (WHERE quality = 1) / count(quality), 3) AS good_percent, count(*) FILTER (WHERE toxic = 1) AS toxic
FROM documents LEFT JOIN (SELECT doc_id, min(quality) AS quality, max(toxic) AS toxic FROM labels GROUP BY doc_id) USING (doc_id) GROUP BY source""")
def label_report(spark, sf_dir):
    marks = table(spark, sf_dir, "labels").groupBy("doc_id").agg(F.min("quality").alias("quality"), F.max("toxic").alias("toxic"))
    rows = table(spark, sf_dir, "documents").select("doc_id", "source").join(marks, "doc_id", "left")
    return rows.groupBy("source").agg(F.count("*").alias("n"), F.round(100.0 * F.count_if(F.col("quality") == 1) / F.count("quality"), 3).alias("good_percent"), F.count_if(F.col("toxic") == 1).alias("toxic"))


@query(r"""SELECT page_id, name, CASE WHEN regexp_matches(name, '^\d+\.html$') THEN 'file' WHEN regexp_matches(name, '^\d+$') THEN 'number' WHEN name = '' THEN 'folder' ELSE 'other' END AS kind
FROM (SELECT page_id, regexp_extract(url, '^[^?#]*/([^/?#]*)', 1) AS name FROM pages)""")
def filename_audit(spark, sf_dir):
    name = F.col("name")
    kind = F.when(name.rlike(r"^\d+\.html$"), "file").when(name.rlike(r"^\d+$"), "number").when(name == "", "folder").otherwise("other")
    return table(spark, sf_dir, "pages").select("page_id", F.regexp_extract("url", "^[^?#]*/([^/?#]*)", 1).alias("name")).withColumn("kind", kind)


@query("""WITH n AS (SELECT doc_id, 'note-' || doc_id % 50 AS name FROM documents) SELECT doc_id, CASE WHEN k = 1 THEN name ELSE name || '-' || k END AS name FROM (SELECT *, row_number() OVER (PARTITION BY name ORDER BY doc_id) AS k FROM n)""")
def rename_proposals(spark, sf_dir):
    """A name of its own for each document: all but the first of a name get a number."""
    rows = table(spark, sf_dir, "documents").select("doc_id", F.concat(F.lit("note-"), (F.col("doc_id") % 50).cast("string")).alias("name"))
    k = F.col("number")
    return ranking.numbered(rows, "name", "doc_id").select("doc_id", F.when(k == 1, F.col("name")).otherwise(F.concat("name", F.lit("-"), k.cast("string"))).alias("name"))


@query(f"""SELECT '{TARGET}' AS target, CAST({WINDOW_DAYS} AS BIGINT) AS window_days, count(*) AS candidates, count(*) FILTER (WHERE priority = 'high') AS high, count(DISTINCT source) AS sources FROM ({CANDIDATE_SQL})""")
def public_state(spark, sf_dir):
    """Counts and dates only: nothing that names a record."""
    c = candidates(spark, sf_dir).agg(F.count("*").alias("candidates"), F.count_if(F.col("priority") == "high").alias("high"), F.countDistinct("source").alias("sources"))
    return c.select(F.lit(TARGET).alias("target"), F.lit(WINDOW_DAYS).cast("long").alias("window_days"), "candidates", "high", "sources")
