"""Aggregation queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from siltworks.functions.numbers import format_number, format_seconds
from siltworks.operators import ranking
from siltworks.plans.registry import query, table


@query("""WITH o AS (SELECT strftime(o_orderdate, '%Y-%m-%d') AS day, o_totalprice, o_orderkey, (row_number() OVER (PARTITION BY strftime(o_orderdate, '%Y-%m-%d') ORDER BY o_orderkey) - 1) // 500 AS part FROM orders),
d AS (SELECT day, count(*) AS n, round(sum(o_totalprice), 2) AS total, round(sum(o_totalprice) / 1000, 1) AS thousands FROM o GROUP BY day)
SELECT day, part, n, total, thousands, array_to_string(list_sort(list(o_orderkey)), ',') AS ids FROM o JOIN d USING (day) GROUP BY ALL""")
def daily_rollup(spark, sf_dir):
    """Figures of each day with its ids, 500 to a row, so that no day is gathered whole."""
    orders = table(spark, sf_dir, "orders").select(F.date_format("o_orderdate", "yyyy-MM-dd").alias("day"), "o_orderkey", "o_totalprice")
    total = F.sum("o_totalprice")
    days = orders.groupBy("day").agg(F.count("*").alias("n"), F.round(total, 2).alias("total"), F.round(total / 1000, 1).alias("thousands"))
    placed = ranking.numbered(orders.select("day", "o_orderkey"), "day", "o_orderkey")
    ids = F.array_join(F.transform(F.sort_array(F.collect_list("o_orderkey")), lambda x: x.cast("string")), ",")
    parts = placed.groupBy("day", F.floor((F.col("number") - 1) / 500).alias("part")).agg(ids.alias("ids"))
    return parts.join(days, "day").select("day", "part", "n", "total", "thousands", "ids")


@query("""SELECT o_orderstatus AS status, o_orderpriority AS priority, CAST(grouping(o_orderstatus) * 2 + grouping(o_orderpriority) AS BIGINT) AS level, count(*) AS n
FROM orders GROUP BY GROUPING SETS ((o_orderstatus), (o_orderpriority), (o_orderstatus, o_orderpriority), ())""")
def multi_counters(spark, sf_dir):
    table(spark, sf_dir, "orders").createOrReplaceTempView("orders_rows")
    return spark.sql("""SELECT o_orderstatus AS status, o_orderpriority AS priority, CAST(grouping_id(o_orderstatus, o_orderpriority) AS BIGINT) AS level, count(*) AS n
        FROM orders_rows GROUP BY GROUPING SETS ((o_orderstatus), (o_orderpriority), (o_orderstatus, o_orderpriority), ())""")


@query("""WITH c AS (SELECT o_orderstatus, o_orderpriority, count(*) AS n FROM orders GROUP BY 1, 2)
SELECT o_orderstatus, o_orderpriority AS mode, n FROM (SELECT *, row_number() OVER (PARTITION BY o_orderstatus ORDER BY n DESC, o_orderpriority) AS k FROM c) WHERE k = 1""")
def group_mode(spark, sf_dir):
    counts = table(spark, sf_dir, "orders").groupBy("o_orderstatus", "o_orderpriority").agg(F.count("*").alias("n"))
    top = ranking.top_per_group(counts, ["o_orderstatus"], [F.desc("n"), F.col("o_orderpriority")], 1)
    return top.select("o_orderstatus", F.col("o_orderpriority").alias("mode"), "n")


@query("""SELECT r_name, n_name, CAST(grouping(r_name) + grouping(n_name) AS BIGINT) AS level, count(c_custkey) AS customers, round(sum(c_acctbal), 2) AS balance
FROM region JOIN nation ON n_regionkey = r_regionkey LEFT JOIN customer ON c_nationkey = n_nationkey GROUP BY ROLLUP (r_name, n_name)""")
def two_level_index(spark, sf_dir):
    region, nation, customer = (table(spark, sf_dir, n) for n in ("region", "nation", "customer"))
    by_nation = customer.groupBy("c_nationkey").agg(F.count("c_custkey").alias("n"), F.sum("c_acctbal").alias("b"))
    rows = region.join(nation, F.col("n_regionkey") == F.col("r_regionkey")).join(by_nation, F.col("c_nationkey") == F.col("n_nationkey"), "left")
    level = (F.grouping("r_name") + F.grouping("n_name")).cast("long").alias("level")
    return rows.rollup("r_name", "n_name").agg(level, F.coalesce(F.sum("n"), F.lit(0)).alias("customers"), F.round(F.sum("b"), 2).alias("balance"))


REASON_SQL = """CASE WHEN text IS NULL OR trim(text) = '' THEN 'empty' WHEN length(text) < 200 THEN 'short' WHEN contains(text, '$$$') OR contains(text, '%%%') THEN 'symbols'
WHEN contains(text, '!!') THEN 'shouting' WHEN contains(text, ' | ') THEN 'table' ELSE 'accepted' END"""


def reason():
    text = F.col("text")
    return (
        F.when(text.isNull() | (F.trim(text) == ""), "empty").when(F.length(text) < 200, "short").when(text.contains("$$$") | text.contains("%%%"), "symbols")
        .when(text.contains("!!"), "shouting").when(text.contains(" | "), "table").otherwise("accepted")
    )


@query(f"SELECT {REASON_SQL} AS reason, count(*) AS n FROM documents GROUP BY 1")
def reason_histogram(spark, sf_dir):
    return table(spark, sf_dir, "documents").groupBy(reason().alias("reason")).agg(F.count("*").alias("n"))


@query(f"SELECT doc_id, {REASON_SQL} AS reason FROM documents")
def candidate_reason(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", reason().alias("reason"))


@query("SELECT source, count(DISTINCT md5(text)) AS bodies, count(DISTINCT lang) AS langs, count(DISTINCT lang) > 1 AS unmerged FROM documents GROUP BY source")
def variant_counts(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("source", "lang", F.md5("text").alias("h"))
    return docs.groupBy("source").agg(F.countDistinct("h").alias("bodies"), F.countDistinct("lang").alias("langs"), (F.countDistinct("lang") > 1).alias("unmerged"))


@query("""SELECT source, count(*) AS file_count, count(*) FILTER (WHERE n_chars > 2000) AS long_count, max(n_chars) AS largest,
array_to_string(list_sort(list(DISTINCT lang)), ',') AS langs, array_to_string(list_sort(list(doc_id))[1:5], ',') AS first_ids FROM documents GROUP BY source""")
def source_profile(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("source", "lang", "doc_id", "n_chars")
    first = ranking.top_per_group(docs, ["source"], [F.col("doc_id")], 5).groupBy("source").agg(F.sort_array(F.collect_list("doc_id")).alias("ids"))
    facts = docs.groupBy("source").agg(
        F.count("*").alias("file_count"), F.count_if(F.col("n_chars") > 2000).alias("long_count"), F.max("n_chars").alias("largest"), F.array_join(F.sort_array(F.collect_set("lang")), ",").alias("langs")
    )
    return facts.join(first, "source").select("source", "file_count", "long_count", "largest", "langs", F.array_join(F.transform("ids", lambda x: x.cast("string")), ",").alias("first_ids"))


@query("""SELECT md5(text) AS identity, count(*) AS members, min(doc_id) AS first_id FROM documents GROUP BY 1 HAVING count(*) > 1""")
def identity_groups(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select(F.md5("text").alias("identity"), "doc_id")
    return docs.groupBy("identity").agg(F.count("*").alias("members"), F.min("doc_id").alias("first_id")).where("members > 1")


#: Themes, their words and weights (fixed values).
THEMES = [("law", "rights", 3), ("law", "license", 3), ("abuse", "idiot", 2), ("abuse", "stupid", 2), ("abuse", "scum", 2), ("ties", "with", 1), ("ties", "from", 1), ("place", "there", 1), ("place", "where", 1)]
THEME_VALUES = ", ".join(f"('{t}', '{w}', {n})" for t, w, n in THEMES)
THEME_SQL = f"""WITH t(theme, word, weight) AS (VALUES {THEME_VALUES}), w AS (SELECT DISTINCT doc_id, source, unnest(regexp_extract_all(lower(text), '[a-z]+')) AS word FROM documents),
h AS (SELECT doc_id, source, theme, max(weight) AS weight FROM w JOIN t USING (word) GROUP BY ALL)"""


def theme_hits(spark, sf_dir):
    """(doc_id, source, theme, weight): themes by whole ASCII words."""
    rules = spark.createDataFrame(THEMES, "theme string, word string, weight long")
    # one pass over a text finds the words of rules, and nothing else leaves the scan
    words = "|".join(sorted({w for _, w, _ in THEMES}))
    found = F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit(rf"(?<![a-z])(?:{words})(?![a-z])"), F.lit(0)))
    named = table(spark, sf_dir, "documents").select("doc_id", "source", F.explode(found).alias("word"))
    return named.join(F.broadcast(rules), "word").groupBy("doc_id", "source", "theme").agg(F.max("weight").alias("weight"))


@query(f"{THEME_SQL} SELECT theme, count(*) AS documents, CAST(sum(weight) AS BIGINT) AS weight, count(DISTINCT source) AS sources FROM h GROUP BY theme")
def theme_counts(spark, sf_dir):
    return theme_hits(spark, sf_dir).groupBy("theme").agg(F.count("*").alias("documents"), F.sum("weight").alias("weight"), F.countDistinct("source").alias("sources"))


@query("""WITH w AS (SELECT unnest(regexp_extract_all(lower(text), '[a-z]+')) AS word FROM documents WHERE lang = 'en'), c AS (SELECT word, count(*) AS n FROM w GROUP BY word)
SELECT word, n FROM c WHERE length(word) > 3 ORDER BY n DESC, word LIMIT 20""")
def topic_words(spark, sf_dir):
    words = table(spark, sf_dir, "documents").where("lang = 'en'").select(F.explode(F.regexp_extract_all(F.lower("text"), F.lit("[a-z]+"), F.lit(0))).alias("word"))
    return words.groupBy("word").agg(F.count("*").alias("n")).where("length(word) > 3").orderBy(F.desc("n"), "word").limit(20)


@query("""SELECT field, shape, count(*) AS n FROM (SELECT unnest(['discount', 'tax', 'flag']) AS field, unnest([CASE WHEN l_discount IS NULL THEN 'null' WHEN l_discount = 0 THEN 'default' ELSE 'other' END,
CASE WHEN l_tax IS NULL THEN 'null' WHEN l_tax = 0 THEN 'default' ELSE 'other' END, CASE WHEN l_returnflag IS NULL THEN 'null' WHEN l_returnflag = 'N' THEN 'default' ELSE 'other' END]) AS shape FROM lineitem) GROUP BY ALL""")
def shape_histogram(spark, sf_dir):
    shape = lambda c, default: F.when(F.col(c).isNull(), "null").when(F.col(c) == default, "default").otherwise("other")
    shaped = table(spark, sf_dir, "lineitem").select(shape("l_discount", 0.0).alias("discount"), shape("l_tax", 0.0).alias("tax"), shape("l_returnflag", "N").alias("flag"))
    return shaped.unpivot([], ["discount", "tax", "flag"], "field", "shape").groupBy("field", "shape").agg(F.count("*").alias("n"))


@query("""WITH v AS (SELECT o_orderkey AS k, CAST(floor(o_totalprice / 10) AS BIGINT) AS s FROM orders)
SELECT k, s AS seconds, CASE WHEN s // 3600 > 0 THEN (s // 3600) || 'h ' ELSE '' END || CASE WHEN s // 60 > 0 THEN (s // 60 % 60) || 'm ' ELSE '' END || (s % 60) || 's' AS text FROM v""")
def duration_text(spark, sf_dir):
    seconds = F.floor(F.col("o_totalprice") / 10).cast("long")
    return table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("k"), seconds.alias("seconds"), format_seconds(seconds).alias("text"))


@query("""SELECT p_partkey, CASE WHEN round(p_retailprice, 2) = floor(p_retailprice) THEN CAST(CAST(p_retailprice AS BIGINT) AS VARCHAR) ELSE regexp_replace(CAST(CAST(p_retailprice AS DECIMAL(18, 2)) AS VARCHAR), '0$', '') END AS price FROM part""")
def number_text(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", format_number(F.col("p_retailprice")).alias("price"))


@query("""SELECT event_type, count(*) AS n, count(*) FILTER (WHERE json_extract_string(props, '$.k') IS NULL) AS without_k, CAST(sum(json_array_length(json_keys(props))) AS BIGINT) AS keys FROM events GROUP BY event_type""")
def opaque_counts(spark, sf_dir):
    props = F.from_json("props", "map<string,string>")
    events = table(spark, sf_dir, "events").select("event_type", props.alias("p"))
    return events.groupBy("event_type").agg(F.count("*").alias("n"), F.count_if(F.col("p")["k"].isNull()).alias("without_k"), F.sum(F.size("p")).alias("keys"))


@query("""WITH a AS (SELECT doc_id, doc_id % 3 <> 1 AS saved, doc_id % 4 <> 1 AS verified, doc_id % 25 = 0 AS held FROM documents)
SELECT count(*) AS observed, count(*) FILTER (WHERE saved) AS saved, count(*) FILTER (WHERE saved AND verified) AS both_verified, count(*) FILTER (WHERE held) AS holds, count(*) FILTER (WHERE NOT (saved AND verified) AND NOT held) AS pending,
CASE WHEN count(*) = count(*) FILTER (WHERE saved AND verified) AND count(*) FILTER (WHERE held) = 0 THEN 'verified' WHEN count(*) FILTER (WHERE held) > 0 THEN 'held' ELSE 'pending' END AS status FROM a""")
def receipt_summary(spark, sf_dir):
    """One row: what an index has observed, saved, verified at both targets, holds and waits for."""
    d = F.col("doc_id")
    saved, both, held = d % 3 != 1, (d % 3 != 1) & (d % 4 != 1), d % 25 == 0
    sums = table(spark, sf_dir, "documents").agg(
        F.count("*").alias("observed"), F.count_if(saved).alias("saved"), F.count_if(both).alias("both_verified"), F.count_if(held).alias("holds"), F.count_if(~both & ~held).alias("pending")
    )
    status = F.when((F.col("observed") == F.col("both_verified")) & (F.col("holds") == 0), "verified").when(F.col("holds") > 0, "held").otherwise("pending")
    return sums.withColumn("status", status)


@query("""WITH e AS (SELECT strftime(ts, '%Y-%m-%d') AS day, count(*) AS n FROM events WHERE event_type = 'signup' GROUP BY 1)
SELECT CASE WHEN n IS NULL THEN 'missing' WHEN n = 1 THEN 'linked' ELSE 'ambiguous' END AS outcome, count(*) AS n, CAST(count(DISTINCT o_custkey) AS BIGINT) AS customers FROM orders LEFT JOIN e ON strftime(o_orderdate, '%Y-%m-%d') = day GROUP BY 1""")
def run_counters(spark, sf_dir):
    """A run's counters by outcome of its links."""
    from siltworks.operators.joining import link_if_unique

    day = lambda c: F.date_format(c, "yyyy-MM-dd").alias("day")
    events = table(spark, sf_dir, "events").where("event_type = 'signup'").select(day("ts"), "event_id")
    linked = link_if_unique(table(spark, sf_dir, "orders").select("o_custkey", day("o_orderdate")), events, "day", "event_id")
    return linked.groupBy("outcome").agg(F.count("*").alias("n"), F.countDistinct("o_custkey").alias("customers"))


@query("""SELECT event_type, strftime(max(ts), '%Y-%m-%d %H:%M:%S') AS last, max(event_id) AS last_id, count(DISTINCT user_id) AS users, arg_max(user_id, (ts, event_id)) AS last_user FROM events GROUP BY event_type""")
def batch_watermarks(spark, sf_dir):
    """What a state keeps of a batch: its newest stamp, the row of it, how many ids."""
    newest = F.max_by("user_id", F.struct("ts", "event_id"))
    return table(spark, sf_dir, "events").groupBy("event_type").agg(F.date_format(F.max("ts"), "yyyy-MM-dd HH:mm:ss").alias("last"), F.max("event_id").alias("last_id"), F.countDistinct("user_id").alias("users"), newest.alias("last_user"))


@query("""WITH t AS (SELECT source, CASE WHEN contains(text, 'rights') THEN 'rights' WHEN contains(text, 'license') THEN 'license' END AS topic, lang FROM documents),
c AS (SELECT source, topic AS name, 0 AS fallback, count(*) AS n FROM t WHERE topic IS NOT NULL GROUP BY ALL UNION ALL SELECT source, lang, 1, count(*) FROM t WHERE source NOT IN (SELECT source FROM t WHERE topic IS NOT NULL) GROUP BY ALL)
SELECT source, name, fallback = 1 AS is_fallback, n, rank FROM (SELECT *, row_number() OVER (PARTITION BY source ORDER BY n DESC, name) AS rank FROM c) WHERE rank <= 2""")
def topics_or_tokens(spark, sf_dir):
    """The two commonest topics of each source; a source without any gets its commonest tokens."""
    from siltworks.operators.ranking import top_per_group

    rows = table(spark, sf_dir, "documents").select("source", F.when(F.contains("text", F.lit("rights")), "rights").when(F.contains("text", F.lit("license")), "license").alias("topic"), "lang")
    topics = rows.where("topic is not null").groupBy("source", F.col("topic").alias("name")).agg(F.count("*").alias("n")).withColumn("is_fallback", F.lit(False))
    tokens = rows.groupBy("source", F.col("lang").alias("name")).agg(F.count("*").alias("n")).join(topics.select("source"), "source", "left_anti").withColumn("is_fallback", F.lit(True))
    return top_per_group(topics.unionByName(tokens), ["source"], [F.desc("n"), F.col("name")], 2).select("source", "name", "is_fallback", "n", "rank")


@query("""WITH e AS (SELECT user_id, event_id, event_type = 'error' AS bad FROM events), s AS (SELECT *, lag(bad) OVER (PARTITION BY user_id ORDER BY event_id) AS b FROM e), c AS (SELECT user_id, event_id, bad FROM s WHERE bad <> coalesce(b, false)),
h AS (SELECT user_id, event_id AS held_at, bad, lead(event_id) OVER (PARTITION BY user_id ORDER BY event_id) AS resolved_at FROM c) SELECT user_id, held_at, resolved_at, CASE WHEN resolved_at IS NULL THEN 'held' ELSE 'resolved' END AS state FROM h WHERE bad""")
def hold_history(spark, sf_dir):
    """Holds of each source with when they were set and resolved; history stays."""
    from pyspark.sql import Window

    from siltworks.operators.ranking import change_points

    w = Window.partitionBy("user_id").orderBy("event_id")
    turns = change_points(table(spark, sf_dir, "events").select("user_id", "event_id", (F.col("event_type") == "error").alias("bad")), "user_id", "event_id", "bad")
    holds = turns.withColumn("resolved_at", F.lead("event_id").over(w)).where("bad")
    return holds.select("user_id", F.col("event_id").alias("held_at"), "resolved_at", F.when(F.col("resolved_at").isNull(), "held").otherwise("resolved").alias("state"))


@query("""WITH p AS (SELECT user_id, count(*) FILTER (WHERE event_type = 'purchase') AS n, max(event_id) AS cursor, max(event_id) FILTER (WHERE event_type = 'purchase') AS claimed FROM events GROUP BY user_id)
SELECT user_id, CASE WHEN n = 0 THEN 'no_promotion' WHEN claimed <> cursor THEN 'cursor_differs' ELSE 'consistent' END AS finding FROM p""")
def promotion_check(spark, sf_dir):
    """Whether a promotion's cursor is the one that its source stands at."""
    sums = table(spark, sf_dir, "events").groupBy("user_id").agg(F.max("event_id").alias("cursor"), F.max(F.when(F.col("event_type") == "purchase", F.col("event_id"))).alias("claimed"))
    finding = F.when(F.col("claimed").isNull(), "no_promotion").when(F.col("claimed") != F.col("cursor"), "cursor_differs").otherwise("consistent")
    return sums.select("user_id", finding.alias("finding"))
