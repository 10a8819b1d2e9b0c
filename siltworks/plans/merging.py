"""Merge, plan and fold queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from siltworks.operators import merging as ops
from siltworks.plans.registry import query, table
from siltworks.plans.rollups import THEME_SQL, theme_hits

FIELDS_SQL = """SELECT doc_id, 'd' || doc_id % 5 AS desired, CASE WHEN doc_id % 7 = 0 THEN NULL ELSE 'd' || doc_id % 4 END AS current, CASE WHEN doc_id % 3 = 0 THEN NULL ELSE 'd' || doc_id % 4 END AS managed FROM documents"""


def fields(spark, sf_dir):
    d = F.col("doc_id")
    text = lambda n: F.concat(F.lit("d"), (d % n).cast("string"))
    return table(spark, sf_dir, "documents").select("doc_id", text(5).alias("desired"), F.when(d % 7 != 0, text(4)).alias("current"), F.when(d % 3 != 0, text(4)).alias("managed"))


@query(f"""SELECT doc_id, CASE WHEN desired IS NOT DISTINCT FROM current THEN CASE WHEN managed IS NOT DISTINCT FROM current THEN 'keep' ELSE 'adopt' END
WHEN managed IS NOT DISTINCT FROM current THEN 'write' WHEN current IS NULL AND managed IS NULL THEN 'write' ELSE 'hold' END AS decision FROM ({FIELDS_SQL})""")
def three_way_merge(spark, sf_dir):
    return fields(spark, sf_dir).select("doc_id", ops.three_way(F.col("desired"), F.col("current"), F.col("managed")).alias("decision"))


@query("""WITH w AS (SELECT doc_id, md5(text) AS v FROM documents WHERE doc_id % 2 = 0), t AS (SELECT doc_id, CASE WHEN doc_id % 5 = 0 THEN md5(text || 'x') ELSE md5(text) END AS v,
CASE WHEN doc_id % 10 = 0 THEN md5(text || 'x') ELSE md5(text) END AS m FROM documents WHERE doc_id % 3 <> 0)
SELECT w.doc_id, CASE WHEN t.doc_id IS NULL THEN 'create' WHEN w.v = t.v THEN 'noop' WHEN t.v = t.m THEN 'update' ELSE 'blocked' END AS action FROM w LEFT JOIN t USING (doc_id)""")
def sink_plan(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    plain, edited = F.md5("text"), F.md5(F.concat("text", F.lit("x")))
    wanted = docs.where("doc_id % 2 = 0").select("doc_id", plain.alias("v"))
    target = docs.where("doc_id % 3 <> 0").select("doc_id", F.when(F.col("doc_id") % 5 == 0, edited).otherwise(plain).alias("v"), F.when(F.col("doc_id") % 10 == 0, edited).otherwise(plain).alias("m"))
    return ops.sink_plan(wanted, target, "doc_id", "v", "m")


@query("""WITH a AS (SELECT l_orderkey, list(DISTINCT l_partkey) AS p, list(DISTINCT l_partkey) FILTER (WHERE l_linenumber % 3 <> 0) AS q FROM lineitem GROUP BY 1),
x AS (SELECT l_orderkey, list_sort(list_filter(p, lambda x: NOT list_contains(coalesce(q, []), x))) AS lost FROM a) SELECT l_orderkey, array_to_string(lost, ',') AS lost FROM x WHERE len(lost) > 0""")
def relation_visibility(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.collect_set("l_partkey").alias("p"), F.collect_set(F.when(F.col("l_linenumber") % 3 != 0, F.col("l_partkey"))).alias("q"))
    lost = ops.visibility(F.create_map(F.lit("parts"), F.col("p")), F.create_map(F.lit("parts"), F.col("q")))
    out = rows.select("l_orderkey", F.sort_array(lost["parts"]).alias("lost")).where("lost is not null")
    return out.select("l_orderkey", F.array_join(F.transform("lost", lambda x: x.cast("string")), ",").alias("lost"))


@query("""WITH RECURSIVE l AS (SELECT l_orderkey AS k, CAST(l_quantity AS BIGINT) AS w, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, CAST(l_quantity AS BIGINT)) AS i FROM lineitem),
b AS (SELECT k, i, w AS total, 1 AS n, 0 AS batch FROM l WHERE i = 1 UNION ALL SELECT l.k, l.i, CASE WHEN b.n >= 3 OR b.total + l.w > 60 THEN l.w ELSE b.total + l.w END, CASE WHEN b.n >= 3 OR b.total + l.w > 60 THEN 1 ELSE b.n + 1 END,
CASE WHEN b.n >= 3 OR b.total + l.w > 60 THEN b.batch + 1 ELSE b.batch END FROM b JOIN l ON l.k = b.k AND l.i = b.i + 1)
SELECT k AS l_orderkey, CAST(max(batch) + 1 AS BIGINT) AS batches, array_to_string(list(batch ORDER BY i), ',') AS assigned FROM b GROUP BY k""")
def batch_packing(spark, sf_dir):
    """Lines of an order packed greedily: at most 3 lines and a quantity of 60 in a batch."""
    weights = F.transform(F.sort_array(F.collect_list(F.struct("l_linenumber", "l_partkey", F.col("l_quantity").cast("long").alias("w")))), lambda x: x["w"])
    packed = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(weights.alias("w")).select("l_orderkey", ops.batches(F.col("w"), 3, 60).alias("b"))
    return packed.select("l_orderkey", (F.array_max("b") + 1).cast("long").alias("batches"), F.array_join(F.transform("b", lambda x: x.cast("string")), ",").alias("assigned"))


@query("""WITH o AS (SELECT conv_id, role, coalesce(text, '') AS text, row_number() OVER w AS i, lag(role) OVER w AS b FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn, role, text)),
g AS (SELECT *, sum(CASE WHEN b = role THEN 0 ELSE 1 END) OVER (PARTITION BY conv_id ORDER BY i) AS r FROM o), m AS (SELECT conv_id, r, first(role) AS role, string_agg(text, '' ORDER BY i) AS t FROM g GROUP BY conv_id, r)
SELECT conv_id, count(*) AS runs, md5(string_agg(role || ':' || md5(t), '|' ORDER BY r)) AS digest FROM m GROUP BY conv_id""")
def merged_runs(spark, sf_dir):
    """Neighbouring turns of one role joined."""
    turn = F.struct("turn", F.col("role").alias("kind"), F.coalesce("text", F.lit("")).alias("text"))
    turns = F.transform(F.sort_array(F.collect_list(turn)), lambda x: F.struct(x["kind"].alias("kind"), x["text"].alias("text")))
    merged = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(turns.alias("t")).select("conv_id", ops.merge_runs(F.col("t")).alias("m"))
    digest = F.md5(F.array_join(F.transform("m", lambda x: F.concat(x["kind"], F.lit(":"), F.md5(x["text"]))), "|"))
    return merged.select("conv_id", F.size("m").cast("long").alias("runs"), digest.alias("digest"))


@query(f"""{THEME_SQL}, g AS (SELECT source, theme, sum(weight) AS weight, count(*) AS support FROM h GROUP BY ALL), r AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY weight DESC, theme) AS k FROM g),
o AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY k) AS n FROM r WHERE k = 1 OR support >= 2 OR length(theme) % 2 = 0) SELECT source, string_agg(theme, ',' ORDER BY n) AS themes FROM o WHERE n <= 3 GROUP BY source""")
def theme_selection(spark, sf_dir):
    hits = theme_hits(spark, sf_dir).groupBy("source", "theme").agg(F.sum("weight").alias("weight"), F.count("*").alias("support"))
    ranked = F.sort_array(F.collect_list(F.struct((-F.col("weight")).alias("order"), F.col("theme").alias("name"), F.col("support"), (F.length("theme") % 2).alias("seen"))))
    return hits.groupBy("source").agg(ops.choose_themes(ranked).alias("chosen")).select("source", F.array_join("chosen", ",").alias("themes"))


@query("""WITH b AS (SELECT source, doc_id // 100 AS period, doc_id FROM documents), l AS (SELECT source, period, max(doc_id) AS doc_id FROM b GROUP BY 1, 2),
r AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY period DESC) AS rank FROM l) SELECT source, CAST(period AS BIGINT) AS period, doc_id, rank FROM r WHERE rank <= 5""")
def managed_blocks(spark, sf_dir):
    blocks = table(spark, sf_dir, "documents").select("source", F.floor(F.col("doc_id") / 100).cast("long").alias("period"), "doc_id")
    return ops.keep_newest(blocks, ["source"], "period", "doc_id")


@query("""SELECT conv_id, CASE WHEN conv_id % 5 = 0 AND count(*) > 1 THEN NULL ELSE CAST(greatest(count(*) - 2, 0) AS BIGINT) END AS appended FROM conversations GROUP BY conv_id""")
def human_append(spark, sf_dir):
    """Turns behind the two managed ones where these are still in place; null where the second was edited by hand."""
    texts = F.transform(F.sort_array(F.collect_list(F.struct("turn", "role", F.md5("text").alias("h")))), lambda x: x["h"])
    rows = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(texts.alias("managed"))
    seen = F.transform("managed", lambda h, place: F.when((F.col("conv_id") % 5 == 0) & (place == 1), F.md5(F.concat(h, F.lit("x")))).otherwise(h))
    return rows.select("conv_id", F.size(ops.unmanaged_suffix(seen, F.slice("managed", 1, 2))).cast("long").alias("appended"))


@query(f"""{THEME_SQL}, d AS (SELECT doc_id, source, doc_id // 100 AS period FROM documents), m AS (SELECT max(period) AS target FROM d), k AS (SELECT DISTINCT doc_id FROM labels),
x AS (SELECT source, count(*) FILTER (WHERE period = target) AS exact, count(*) FILTER (WHERE period > target - 3) AS in_window, max(doc_id) AS latest, count(*) FILTER (WHERE period = target AND k.doc_id IS NOT NULL) AS covered,
  count(*) FILTER (WHERE period > target - 3 AND k.doc_id IS NULL) AS candidates FROM d CROSS JOIN m LEFT JOIN k USING (doc_id) GROUP BY source),
a AS (SELECT source, theme, period = target AS exact, sum(weight) AS weight, count(*) AS support FROM h JOIN d USING (doc_id, source) CROSS JOIN m WHERE period > target - 3 GROUP BY ALL),
b AS (SELECT source, theme, 1 AS tier, sum(weight) FILTER (WHERE exact) AS weight FROM a GROUP BY source, theme HAVING bool_or(exact) UNION ALL SELECT source, theme, 2, sum(weight) FROM a GROUP BY source, theme),
c AS (SELECT source, theme, tier, row_number() OVER (PARTITION BY source, tier ORDER BY weight DESC, theme) AS n, min(tier) OVER (PARTITION BY source) AS best FROM b),
z AS (SELECT source, string_agg(theme, ',' ORDER BY n) AS themes FROM c WHERE tier = best AND n <= CASE tier WHEN 1 THEN 3 ELSE 2 END GROUP BY source)
SELECT x.source, target AS period, exact, in_window, latest, candidates, coalesce(themes, '') AS themes, CASE WHEN exact = 0 THEN 'window_only' WHEN covered = exact THEN 'complete' WHEN covered > 0 THEN 'partial' ELSE 'open' END AS status FROM x CROSS JOIN m LEFT JOIN z ON z.source = x.source""")
def closeout_report(spark, sf_dir):
    """The closing report of a period: each source's entries of the period and its window, open candidates, themes (of the period, else of the window), status."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", F.floor(F.col("doc_id") / 100).alias("period"))
    target = docs.agg(F.max("period")).first()[0] or 0
    marks = table(spark, sf_dir, "labels").select("doc_id").distinct().withColumn("marked", F.lit(True))
    now, near = F.col("period") == target, F.col("period") > target - 3
    facts = docs.join(marks, "doc_id", "left").groupBy("source").agg(
        F.count_if(now).alias("exact"), F.count_if(near).alias("in_window"), F.max("doc_id").alias("latest"), F.count_if(now & F.col("marked")).alias("covered"), F.count_if(near & F.col("marked").isNull()).alias("candidates"),
    )
    hits = theme_hits(spark, sf_dir).withColumn("period", F.floor(F.col("doc_id") / 100)).where(near)
    weights = hits.groupBy("source", "theme").agg(F.sum(F.when(now, F.col("weight"))).alias("exact"), F.sum("weight").alias("window"))
    # a handful of themes
    ranked = lambda c: F.transform(F.array_sort(F.collect_list(F.when(F.col(c).isNotNull(), F.struct((-F.col(c)).alias("order"), "theme")))), lambda x: x["theme"])
    chosen = weights.groupBy("source").agg(ranked("exact").alias("exact_themes"), ranked("window").alias("window_themes"))
    themes = F.when(F.size("exact_themes") > 0, F.slice("exact_themes", 1, 3)).otherwise(F.slice("window_themes", 1, 2))
    status = F.when(F.col("exact") == 0, "window_only").when(F.col("covered") == F.col("exact"), "complete").when(F.col("covered") > 0, "partial").otherwise("open")
    joined = facts.join(chosen, "source", "left")
    return joined.select("source", F.lit(target).cast("long").alias("period"), "exact", "in_window", "latest", "candidates", F.coalesce(F.array_join(themes, ","), F.lit("")).alias("themes"), status.alias("status"))
