"""Snapshot, version and set queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from siltworks.functions.hashing import stable_url
from siltworks.operators import changes as ops
from siltworks.plans.registry import CURRENT_SQL, PRIOR_SQL, query, snapshots, table

VERSION_SQL = "sha256(concat_ws(chr(10), coalesce('=' || source, '~'), coalesce('=' || lang, '~'), coalesce('=' || body, '~')))"
PAIR_SQL = f"WITH p AS (SELECT doc_id, source, lang, body, {VERSION_SQL} AS version FROM ({PRIOR_SQL})), c AS (SELECT doc_id, source, lang, body, {VERSION_SQL} AS version FROM ({CURRENT_SQL}))"


def versioned(spark, sf_dir):
    return tuple(s.withColumn("version", ops.version_of("source", "lang", "body")) for s in snapshots(spark, sf_dir))


@query(f"""{PAIR_SQL} SELECT coalesce(p.doc_id, c.doc_id) AS doc_id, p.version AS before, c.version AS after,
CASE WHEN p.doc_id IS NULL THEN 'added' WHEN c.doc_id IS NULL THEN 'removed' WHEN p.version = c.version THEN 'unchanged' ELSE 'changed' END AS change
FROM p FULL JOIN c ON p.doc_id = c.doc_id""")
def snapshot_diff(spark, sf_dir):
    return ops.snapshot_diff(*versioned(spark, sf_dir), "doc_id", "version")


@query(f"""{PAIR_SQL}, d AS (SELECT coalesce(p.source, c.source) AS source,
CASE WHEN p.doc_id IS NULL THEN 'added' WHEN c.doc_id IS NULL THEN 'removed' WHEN p.version = c.version THEN 'unchanged' ELSE 'changed' END AS change
FROM p FULL JOIN c ON p.doc_id = c.doc_id) SELECT source, change, count(*) AS n FROM d GROUP BY source, change""")
def change_categories(spark, sf_dir):
    prior, current = versioned(spark, sf_dir)
    names = prior.select("doc_id", "source").unionByName(current.select("doc_id", "source")).distinct()
    return ops.snapshot_diff(prior, current, "doc_id", "version").join(names, "doc_id").groupBy("source", "change").agg(F.count("*").alias("n"))


@query(f"""{PAIR_SQL} SELECT (SELECT count(*) FROM p JOIN c USING (doc_id)) AS in_both, (SELECT count(*) FROM p ANTI JOIN c USING (doc_id)) AS only_left,
(SELECT count(*) FROM c ANTI JOIN p USING (doc_id)) AS only_right, (SELECT count(*) FROM (SELECT doc_id FROM c WHERE doc_id % 9 = 0)) AS duplicated""")
def inventory_census(spark, sf_dir):
    """Ids of two lists that have each other's; a ninth of the second list comes twice."""
    prior, current = snapshots(spark, sf_dir)
    return ops.set_counts(prior, current.unionByName(current.where("doc_id % 9 = 0")), "doc_id")


@query(f"""{PAIR_SQL} SELECT c.doc_id, CASE WHEN p.doc_id IS NULL THEN 'new' WHEN p.version = c.version THEN 'unchanged' ELSE 'changed' END AS outcome
FROM c LEFT JOIN p ON p.doc_id = c.doc_id""")
def version_classify(spark, sf_dir):
    prior, current = versioned(spark, sf_dir)
    return ops.classify_scan(current, prior, "doc_id", "version").select("doc_id", "outcome")


@query(f"""{PAIR_SQL} SELECT doc_id, version, 'current' AS origin FROM c UNION ALL SELECT doc_id, version, 'retained' FROM p WHERE doc_id NOT IN (SELECT doc_id FROM c)""")
def retained_upsert(spark, sf_dir):
    prior, current = versioned(spark, sf_dir)
    state = prior.select("doc_id", "version", F.lit("retained").alias("origin"))
    return ops.upsert(state, current.select("doc_id", "version", F.lit("current").alias("origin")), ["doc_id"])


@query(f"""{PAIR_SQL} SELECT c.doc_id, c.version FROM c LEFT JOIN p USING (doc_id) WHERE p.version IS NULL OR p.version <> c.version""")
def write_if_changed(spark, sf_dir):
    prior, current = versioned(spark, sf_dir)
    return ops.changed_only(prior, current.select("doc_id", "version"), ["doc_id"], "version")


@query("""WITH s AS (SELECT source, min(doc_id) AS lo, count(*) AS n FROM documents WHERE doc_id % 10 <> 0 AND source <> 'src3' GROUP BY source),
c AS (SELECT source, min(doc_id) AS lo, count(*) AS n FROM documents WHERE doc_id % 11 <> 0 AND source <> 'src5' GROUP BY source)
SELECT coalesce(s.source, c.source) AS source, coalesce(s.n, 0) AS n_before, coalesce(c.n, 0) AS n_after,
CASE WHEN s.source IS NULL THEN 'added' WHEN c.source IS NULL THEN 'removed' WHEN s.n <> c.n OR s.lo <> c.lo THEN 'resized' ELSE 'same' END AS delta
FROM s FULL JOIN c ON s.source = c.source""")
def source_delta(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    profile = lambda d, x: d.groupBy("source").agg(F.min("doc_id").alias(f"lo{x}"), F.count("*").alias(f"n{x}"))
    before, after = profile(docs.where("doc_id % 10 <> 0 and source <> 'src3'"), 1), profile(docs.where("doc_id % 11 <> 0 and source <> 'src5'"), 2)
    delta = F.when(F.col("n1").isNull(), "added").when(F.col("n2").isNull(), "removed").when((F.col("n1") != F.col("n2")) | (F.col("lo1") != F.col("lo2")), "resized").otherwise("same")
    return before.join(after, "source", "full").select("source", F.coalesce("n1", F.lit(0)).alias("n_before"), F.coalesce("n2", F.lit(0)).alias("n_after"), delta.alias("delta"))


@query("""WITH v AS (SELECT conv_id, turn, role, sha256(coalesce(text, '')) AS h FROM conversations)
SELECT conv_id, turn, role, h AS text_hash FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC, role DESC, h DESC) AS k FROM v) WHERE k = 1""")
def latest_version_dedup(spark, sf_dir):
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", F.sha2(F.coalesce("text", F.lit("")), 256).alias("text_hash"))
    return ops.latest(rows, ["conv_id"], F.desc("turn"), F.desc("role"), F.desc("text_hash"))


@query("""WITH h AS (SELECT sha256(concat_ws(chr(10), '=' || doc_id, '=' || text)) AS h FROM documents), p AS (SELECT CAST('0x' || substr(h, 1, 15) AS HUGEINT) AS a, CAST('0x' || substr(h, 16, 15) AS HUGEINT) AS b,
CAST('0x' || substr(h, 31, 15) AS HUGEINT) AS c, CAST('0x' || substr(h, 46, 15) AS HUGEINT) AS d FROM h) SELECT count(*) AS rows, sha256(concat_ws(':', sum(a), sum(b), sum(c), sum(d))) AS fingerprint FROM p""")
def tree_fingerprint(spark, sf_dir):
    return ops.tree_fingerprint(table(spark, sf_dir, "documents"), "doc_id", "text")


@query("""SELECT page_id, sha256(regexp_replace(regexp_replace(coalesce(url, ''), '#.*$', ''), '[?].*$', '')) AS url_hash FROM pages""")
def stable_url_hash(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", F.sha2(stable_url(F.coalesce("url", F.lit(""))), 256).alias("url_hash"))


@query(f"""{PAIR_SQL} SELECT g AS field_group, count(*) FILTER (WHERE changed) AS n_changed, count(*) AS n_pairs FROM (
SELECT unnest(['body', 'length', 'place']) AS g, unnest([p.body <> c.body, length(p.body) <> length(c.body), p.source <> c.source OR p.lang <> c.lang]) AS changed
FROM p JOIN c USING (doc_id)) GROUP BY g""")
def field_change_counts(spark, sf_dir):
    prior, current = snapshots(spark, sf_dir)
    both = prior.alias("p").join(current.alias("c"), "doc_id")
    differs = lambda a, b: ~a.eqNullSafe(b)
    groups = F.array(
        F.struct(F.lit("body").alias("g"), differs(F.col("p.body"), F.col("c.body")).alias("x")),
        F.struct(F.lit("length").alias("g"), differs(F.length("p.body"), F.length("c.body")).alias("x")),
        F.struct(F.lit("place").alias("g"), (differs(F.col("p.source"), F.col("c.source")) | differs(F.col("p.lang"), F.col("c.lang"))).alias("x")),
    )
    each = both.select(F.explode(groups).alias("e"))
    return each.groupBy(F.col("e.g").alias("field_group")).agg(F.count_if("e.x").alias("n_changed"), F.count("*").alias("n_pairs"))


@query("""WITH b AS (SELECT doc_id, source FROM documents WHERE doc_id % 3 = 0 UNION ALL SELECT doc_id, source FROM documents WHERE doc_id % 5 = 0)
SELECT doc_id, min(source) AS source, count(*) AS n FROM b GROUP BY doc_id HAVING count(*) > 1""")
def duplicate_ids(spark, sf_dir):
    """Ids that one scan shows twice: a strict scan stops on them."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source")
    scan = docs.where("doc_id % 3 = 0").unionByName(docs.where("doc_id % 5 = 0"))
    return scan.groupBy("doc_id").agg(F.min("source").alias("source"), F.count("*").alias("n")).where("n > 1")


@query("""WITH b AS (SELECT doc_id, 1 AS priority FROM documents WHERE doc_id % 4 = 0 UNION ALL SELECT doc_id, 2 FROM documents WHERE doc_id % 6 = 0)
SELECT doc_id, CAST(min(priority) AS BIGINT) AS priority FROM b WHERE doc_id % 9 <> 0 GROUP BY doc_id""")
def first_writer_wins(spark, sf_dir):
    """Pinned and searched targets together, less an ignore list; the first list that has an id names it."""
    docs = table(spark, sf_dir, "documents").select("doc_id")
    wanted = docs.where("doc_id % 4 = 0").withColumn("priority", F.lit(1)).unionByName(docs.where("doc_id % 6 = 0").withColumn("priority", F.lit(2)))
    ignored = docs.where("doc_id % 9 = 0")
    kept = ops.latest(wanted.join(ignored, "doc_id", "left_anti"), ["doc_id"], F.col("priority"))
    return kept.select("doc_id", F.col("priority").cast("long").alias("priority"))
