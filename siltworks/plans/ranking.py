"""Ranking, queue and top-k queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from siltworks.operators import ranking as ops
from siltworks.plans.registry import query, table


@query("""SELECT doc_id, source, turn, wrapped FROM (SELECT doc_id, source, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS turn,
min(doc_id) OVER (PARTITION BY source) <= 6 AS wrapped FROM documents) WHERE turn <= 3""")
def fair_drain_order(spark, sf_dir):
    """First three turns of a drain that continues after key 6."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source")
    first = docs.groupBy("source").agg(F.min("doc_id").alias("key_first"))
    top = ops.top_per_group(docs, ["source"], [F.col("doc_id")], 3, "turn")
    return top.join(first, "source").select("doc_id", "source", "turn", (F.col("key_first") <= 6).alias("wrapped"))


@query("SELECT doc_id FROM documents ORDER BY doc_id <= 150, doc_id LIMIT 50")
def rotating_audit(spark, sf_dir):
    return ops.after_cursor(table(spark, sf_dir, "documents").select("doc_id"), "doc_id", 150, 50)


@query("""WITH k AS (SELECT ts, event_id FROM events WHERE event_id = 100)
SELECT e.event_id, CAST(e.ts AS VARCHAR)[1:19] AS stamp FROM events e, k WHERE e.ts > k.ts OR e.ts = k.ts AND e.event_id > k.event_id ORDER BY e.ts, e.event_id LIMIT 200""")
def keyset_page(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("ts", "event_id")
    last = events.where("event_id = 100").first()
    page = ops.page_after(events, ["ts", "event_id"], [last["ts"], last["event_id"]], 200)
    return page.select("event_id", F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("stamp"))


@query("SELECT user_id, max(event_id) AS last FROM events GROUP BY user_id")
def queue_rotation(spark, sf_dir):
    return ops.queue_order(table(spark, sf_dir, "events"), "user_id", "event_id")


@query("""WITH d AS (SELECT doc_id, source, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS k FROM documents),
a AS (SELECT doc_id, 'audit' AS slot FROM d WHERE k % 4 = 0 ORDER BY doc_id LIMIT 25), b AS (SELECT doc_id, 'deferred' AS slot FROM d WHERE k % 4 = 1 ORDER BY doc_id DESC LIMIT 50),
f AS (SELECT doc_id, 'fresh' AS slot FROM d WHERE k % 4 >= 2 ORDER BY doc_id DESC LIMIT 25) SELECT * FROM a UNION ALL SELECT * FROM b UNION ALL SELECT * FROM f""")
def budgeted_slots(spark, sf_dir):
    """A budget of 100 reads: 25 to audit, 50 deferred, 25 fresh."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source")
    numbered = ops.numbered(docs, "source", "doc_id", "k")
    pick = lambda cond, order, n, slot: numbered.where(cond).orderBy(order).limit(n).select("doc_id", F.lit(slot).alias("slot"))
    parts = pick("k % 4 = 0", F.col("doc_id"), 25, "audit"), pick("k % 4 = 1", F.desc("doc_id"), 50, "deferred"), pick("k % 4 >= 2", F.desc("doc_id"), 25, "fresh")
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query("""WITH o AS (SELECT o_custkey, o_orderkey, o_orderdate, rank() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC) AS r FROM orders)
SELECT o_custkey, o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS day FROM o WHERE r = 1""")
def newest_with_ties(spark, sf_dir):
    newest = ops.with_ties(table(spark, sf_dir, "orders"), ["o_custkey"], F.desc("o_orderdate"))
    return newest.select("o_custkey", "o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd").alias("day"))


@query("""WITH r AS (SELECT l_suppkey, l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_extendedprice, row_number() OVER (PARTITION BY l_suppkey ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber) AS rank,
count(*) OVER (PARTITION BY l_suppkey) AS size FROM lineitem) SELECT l_suppkey, l_orderkey, l_linenumber, round(l_extendedprice, 2) AS price, rank, greatest(size - 12, 0) AS overflow FROM r WHERE rank <= 12""")
def topk_per_group(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").select("l_suppkey", "l_orderkey", F.col("l_linenumber").cast("long").alias("l_linenumber"), "l_extendedprice")
    top = ops.with_overflow(rows, ["l_suppkey"], [F.desc("l_extendedprice"), F.col("l_orderkey"), F.col("l_linenumber")], 12)
    return top.select("l_suppkey", "l_orderkey", "l_linenumber", F.round("l_extendedprice", 2).alias("price"), "rank", "overflow")


@query("""WITH w AS (SELECT event_type, datediff('day', DATE '1970-01-01', CAST(ts AS DATE)) AS day, max(value) < 4.9 * avg(value) AS ok FROM events GROUP BY 1, 2),
g AS (SELECT event_type, day, day - row_number() OVER (PARTITION BY event_type ORDER BY day) AS run FROM w WHERE ok),
r AS (SELECT event_type, run, count(*) AS n, max(day) AS e FROM g GROUP BY 1, 2), l AS (SELECT event_type, max(day) AS last FROM w GROUP BY 1),
b AS (SELECT event_type, n, e, row_number() OVER (PARTITION BY event_type ORDER BY n DESC, e) AS k FROM r)
SELECT l.event_type, coalesce(b.n, 0) AS longest, CAST(b.e AS BIGINT) AS longest_end, coalesce((SELECT n FROM r WHERE r.event_type = l.event_type AND r.e = l.last), 0) AS current
FROM l LEFT JOIN b ON b.event_type = l.event_type AND b.k = 1""")
def success_streak(spark, sf_dir):
    """Longest and current run of days without an outlier, for each event type."""
    events = table(spark, sf_dir, "events")
    days = events.groupBy("event_type", F.datediff(F.to_date("ts"), F.lit("1970-01-01").cast("date")).cast("long").alias("day"))
    days = days.agg((F.max("value") < 4.9 * F.avg("value")).alias("ok"))
    return ops.streaks(days, "event_type", "day", "ok")


@query("""WITH s AS (SELECT user_id, event_id, event_id - lag(event_id) OVER (PARTITION BY user_id ORDER BY event_id) AS d FROM events)
SELECT user_id, count(*) FILTER (WHERE d <> 1) AS gaps FROM s GROUP BY user_id""")
def sequence_gaps(spark, sf_dir):
    return ops.contiguous(table(spark, sf_dir, "events"), "user_id", "event_id")


@query("""SELECT user_id, event_id, event_type FROM (SELECT *, lag(event_type) OVER w AS b, row_number() OVER w AS k FROM events WINDOW w AS (PARTITION BY user_id ORDER BY event_id))
WHERE k = 1 OR event_type <> b""")
def change_point(spark, sf_dir):
    return ops.change_points(table(spark, sf_dir, "events"), "user_id", "event_id", "event_type").select("user_id", "event_id", "event_type")


@query("""WITH c AS (SELECT conv_id, turn, role, lag(role) OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS before FROM conversations)
SELECT conv_id, turn, role, before IS NULL OR before <> role AS starts_segment FROM c""")
def sibling_numbering(spark, sf_dir):
    """Whether a turn starts a segment: the one before it has another role."""
    from pyspark.sql import Window

    before = F.lag("role").over(Window.partitionBy("conv_id").orderBy("turn", "role", "text"))
    starts = before.isNull() | (before != F.col("role"))
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", starts.alias("starts_segment"))


@query("""SELECT doc_id, source, rank FROM (SELECT doc_id, source, row_number() OVER (PARTITION BY source ORDER BY abs(doc_id % 17 - 8), doc_id) AS rank FROM documents) WHERE rank = 1""")
def best_scored(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "source")
    return ops.top_per_group(docs, ["source"], [F.abs(F.col("doc_id") % 17 - 8), F.col("doc_id")], 1)


@query("""SELECT event_type, event_id, slot FROM (SELECT event_type, event_id, (row_number() OVER (PARTITION BY event_type ORDER BY event_id) - 1) // 64 AS slot FROM events)""")
def replay_segments(spark, sf_dir):
    """Segments of 64 ids for a replay."""
    rows = ops.numbered(table(spark, sf_dir, "events").select("event_type", "event_id"), "event_type", "event_id", "n")
    return rows.select("event_type", "event_id", F.floor((F.col("n") - 1) / 64).cast("long").alias("slot"))


@query("""WITH p AS (SELECT doc_id, source, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS turn, min(doc_id) OVER (PARTITION BY source) AS f FROM documents WHERE source <> 'src1')
SELECT doc_id, source, turn, f <= 6 AS wrapped, row_number() OVER (ORDER BY turn, f <= 6, f) AS position FROM p ORDER BY position LIMIT 120""")
def fair_drain(spark, sf_dir):
    """The next 120 deliveries: paused keys left out, keys in turn, the drain goes on after key 6."""
    pending = table(spark, sf_dir, "documents").select("doc_id", "source").where("source <> 'src1'")
    return ops.fair_order(pending, "source", "doc_id", 120, cursor=6).select("doc_id", "source", "turn", "wrapped", "position")


@query("""WITH s AS (SELECT DISTINCT source FROM documents), o AS (SELECT source, row_number() OVER (ORDER BY source) - 1 AS i, count(*) OVER () AS n FROM s),
p AS (SELECT source, coalesce(min(doc_id) FILTER (WHERE doc_id > 300), min(doc_id)) AS doc_id FROM documents WHERE doc_id % 4 = 1 GROUP BY source)
SELECT CAST((i + n - 5 % n) % n AS BIGINT) AS place, source, doc_id FROM o LEFT JOIN p USING (source)""")
def source_rotation(spark, sf_dir):
    """Sources from a rotating start, each with the partial item after its cursor, going round."""
    docs = table(spark, sf_dir, "documents").select("source", "doc_id")
    items = docs.where("doc_id % 4 = 1").groupBy("source").agg(F.coalesce(F.min(F.when(F.col("doc_id") > 300, F.col("doc_id"))), F.min("doc_id")).alias("doc_id"))
    from pyspark.sql import Window

    # one row a source: a small list of configured collections
    order = docs.select("source").distinct().withColumn("i", F.row_number().over(Window.orderBy("source")) - 1).withColumn("n", F.count("*").over(Window.partitionBy()))
    place = F.pmod(F.col("i") - F.pmod(F.lit(5), F.col("n")), F.col("n"))
    return order.join(items, "source", "left").select(place.cast("long").alias("place"), "source", "doc_id")


@query("""WITH p AS (SELECT conv_id, turn, CASE role WHEN 'assistant' THEN 1 WHEN 'user' THEN 2 ELSE 3 END AS r, role, md5(text) AS h FROM conversations)
SELECT conv_id, turn, role, row_number() OVER (PARTITION BY conv_id ORDER BY r, turn, role, h) AS reading_rank, h FROM p""")
def reading_rank(spark, sf_dir):
    """Parts of a group in reading order: named kinds first, unknown ones after them."""
    from pyspark.sql import Window

    wanted = F.array(F.lit("assistant"), F.lit("user"))
    place = F.array_position(wanted, F.col("role"))
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", F.md5("text").alias("h"), F.when(place == 0, 3).otherwise(place).alias("place"))
    rank = F.row_number().over(Window.partitionBy("conv_id").orderBy("place", "turn", "role", "h")).cast("long")
    return rows.select("conv_id", "turn", "role", rank.alias("reading_rank"), "h")


@query("""WITH p AS (SELECT o_custkey, o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE o_orderdate END AS updated, CASE WHEN o_orderkey % 9 = 0 THEN NULL ELSE o_orderdate - INTERVAL 1 DAY END AS created, o_orderpriority FROM orders)
SELECT o_custkey, o_orderkey, rank FROM (SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY coalesce(updated, created) DESC NULLS LAST, lower(o_orderpriority), o_orderkey) AS rank FROM p) WHERE rank <= 5""")
def fallback_order(spark, sf_dir):
    """Newest first by a stamp or the one in its place, rows without any last, then by folded name and id."""
    rows = table(spark, sf_dir, "orders")
    updated, created = F.when(F.col("o_orderkey") % 3 != 0, F.col("o_orderdate")), F.when(F.col("o_orderkey") % 9 != 0, F.col("o_orderdate") - F.expr("INTERVAL 1 DAY"))
    order = [F.coalesce(updated, created).desc_nulls_last(), F.lower("o_orderpriority"), F.col("o_orderkey")]
    return ops.top_per_group(rows, ["o_custkey"], order, 5).select("o_custkey", "o_orderkey", "rank")


@query("""WITH s AS (SELECT event_type, ts, event_id FROM events WHERE ts >= TIMESTAMP '2024-01-05' - INTERVAL 2 DAY), n AS (SELECT event_type, row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) AS k, ts FROM s)
SELECT event_type, count(*) FILTER (WHERE k <= 150) AS n_read, count(*) >= 150 AS partial, strftime(CASE WHEN count(*) >= 150 THEN TIMESTAMP '2024-01-05' ELSE greatest(TIMESTAMP '2024-01-05', max(ts)) END, '%Y-%m-%d %H:%M:%S') AS watermark FROM n GROUP BY event_type""")
def partial_scans(spark, sf_dir):
    """Capped scans after a watermark with a look-back: one that reaches its cap is partial and leaves the watermark."""
    cap, held = 150, F.lit("2024-01-05").cast("timestamp_ntz")
    due = table(spark, sf_dir, "events").where(F.col("ts") >= held - F.expr("INTERVAL 2 DAYS")).groupBy("event_type").agg(F.count("*").alias("n"), F.max("ts").alias("last"))
    partial = F.col("n") >= cap
    mark = F.when(partial, held).otherwise(F.greatest(held, "last"))
    return due.select("event_type", F.least("n", F.lit(cap)).alias("n_read"), partial.alias("partial"), F.date_format(mark, "yyyy-MM-dd HH:mm:ss").alias("watermark"))


@query("""WITH l AS (SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS k FROM events) SELECT user_id, event_id AS last, row_number() OVER (ORDER BY event_id) AS place FROM l WHERE k = 1""")
def queue_places(spark, sf_dir):
    """A queue where a key that arrives again moves to the tail, with each key's place."""
    last = ops.queue_order(table(spark, sf_dir, "events"), "user_id", "event_id").withColumn("all", F.lit(0))
    return ops.numbered(last, "all", "last", "place").select("user_id", "last", "place")


@query("""WITH r AS (SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS back, event_id % 10 <> 3 AS verified FROM events),
b AS (SELECT user_id, min(back) AS hit FROM r WHERE NOT verified GROUP BY user_id)
SELECT r.user_id, count(*) FILTER (WHERE r.back < coalesce(hit, 25) AND r.back <= 24) AS admitted, coalesce(min(hit), 25) <= 24 AS anchored FROM r LEFT JOIN b USING (user_id) GROUP BY r.user_id""")
def chain_admission(spark, sf_dir):
    """Receipts walked back from the newest to an anchor, 24 at most."""
    rows = ops.top_per_group(table(spark, sf_dir, "events").select("user_id", "event_id"), ["user_id"], [F.desc("event_id")], 24, "back")
    hit = rows.groupBy("user_id").agg(F.min(F.when(F.col("event_id") % 10 == 3, F.col("back"))).alias("hit"), F.count("*").alias("n"))
    return hit.select("user_id", F.least(F.coalesce(F.col("hit") - 1, F.col("n")), F.col("n")).alias("admitted"), F.col("hit").isNotNull().alias("anchored"))


@query("""SELECT user_id, event_id AS last FROM (SELECT user_id, max(event_id) AS event_id FROM events GROUP BY user_id) ORDER BY event_id DESC LIMIT 40""")
def recent_ids(spark, sf_dir):
    """The ids seen last, each once, up to a limit: older ones are forgotten."""
    return ops.queue_order(table(spark, sf_dir, "events"), "user_id", "event_id").orderBy(F.desc("last")).limit(40)
