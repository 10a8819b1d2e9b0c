"""Queries whose joins have rules."""

from __future__ import annotations

from pyspark.sql import functions as F

from siltworks.operators import joining as ops
from siltworks.operators import trees
from siltworks.plans.registry import query, table
from siltworks.sources import paged


@query("""WITH e AS (SELECT strftime(ts, '%Y-%m-%d') AS day, count(*) AS n, min(event_id) AS event_id FROM events WHERE event_type = 'purchase' GROUP BY 1)
SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS day, CASE WHEN n = 1 THEN event_id END AS event_id, CASE WHEN n IS NULL THEN 'missing' WHEN n = 1 THEN 'linked' ELSE 'ambiguous' END AS outcome
FROM orders LEFT JOIN e ON strftime(o_orderdate, '%Y-%m-%d') = day""")
def date_cardinality_link(spark, sf_dir):
    day = lambda c: F.date_format(c, "yyyy-MM-dd").alias("day")
    events = table(spark, sf_dir, "events").where("event_type = 'purchase'").select(day("ts"), "event_id")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", day("o_orderdate"))
    return ops.link_if_unique(orders, events, "day", "event_id").select("o_orderkey", "day", "event_id", "outcome")


@query("""WITH k AS (SELECT regexp_extract(url, '://([^/?#]+)', 1) AS host, page_id FROM pages), g AS (SELECT host, min(page_id) AS first_id, count(*) AS n FROM k GROUP BY host)
SELECT page_id, host, first_id, n, n = 1 AS is_unique FROM k JOIN g USING (host)""")
def exact_key_relations(spark, sf_dir):
    """Each page with the class of its key: its first page, its size, and whether the key is unique.

    Classes are counted before the join, so a key that many pages share costs no more than others.
    """
    pages = table(spark, sf_dir, "pages").select("page_id", F.regexp_extract("url", "://([^/?#]+)", 1).alias("host"))
    classes = pages.groupBy("host").agg(F.min("page_id").alias("first_id"), F.count("*").alias("n"))
    return pages.join(classes, "host").select("page_id", "host", "first_id", "n", (F.col("n") == 1).alias("is_unique"))


@query("""WITH a AS (SELECT doc_id, md5(text) AS v FROM documents WHERE doc_id % 3 = 0), b AS (SELECT doc_id, md5(CASE WHEN doc_id % 8 = 0 THEN text || '!' ELSE text END) AS v FROM documents WHERE doc_id % 4 = 0)
SELECT a.doc_id, CASE WHEN b.doc_id IS NULL THEN 'pending' WHEN a.v = b.v THEN 'verified' ELSE 'differs' END AS status FROM a LEFT JOIN b USING (doc_id)""")
def receipt_pair_status(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    a = docs.where("doc_id % 3 = 0").select("doc_id", F.md5("text").alias("va"))
    b = docs.where("doc_id % 4 = 0").select("doc_id", F.md5(F.when(F.col("doc_id") % 8 == 0, F.concat("text", F.lit("!"))).otherwise(F.col("text"))).alias("vb"))
    status = F.when(F.col("vb").isNull(), "pending").when(F.col("va") == F.col("vb"), "verified").otherwise("differs")
    return a.join(b, "doc_id", "left").select("doc_id", status.alias("status"))


@query("SELECT doc_id, source FROM documents WHERE doc_id % 3 <> 0 AND doc_id % 5 <> 0 AND source NOT IN ('src1', 'src2')")
def plan_minus_delivered(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "source")
    left = ops.minus(docs, ["doc_id"], docs.where("doc_id % 3 = 0"), docs.where("doc_id % 5 = 0"))
    return left.where(~F.col("source").isin("src1", "src2"))


@query("""SELECT d.doc_id, sha256(d.doc_id || ':' || md5(d.text)) AS token FROM documents d WHERE sha256(d.doc_id || ':' || md5(d.text)) IN (SELECT sha256(doc_id || ':' || md5(text)) FROM documents WHERE doc_id % 13 = 0)""")
def hash_token_join(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", F.sha2(F.concat_ws(":", F.col("doc_id").cast("string"), F.md5("text")), 256).alias("token"))
    return docs.join(docs.where("doc_id % 13 = 0").select("token"), "token", "left_semi").select("doc_id", "token")


@query("""WITH d AS (SELECT doc_id FROM documents WHERE doc_id % 2 = 0), l AS (SELECT DISTINCT doc_id FROM labels), m AS (SELECT item_id * 5 AS doc_id FROM benchmark)
SELECT coalesce(d.doc_id, l.doc_id, m.doc_id) AS doc_id, concat(CASE WHEN d.doc_id IS NULL THEN '-' ELSE 'd' END, CASE WHEN l.doc_id IS NULL THEN '-' ELSE 'l' END, CASE WHEN m.doc_id IS NULL THEN '-' ELSE 'm' END) AS families
FROM d FULL JOIN l ON d.doc_id = l.doc_id FULL JOIN m ON coalesce(d.doc_id, l.doc_id) = m.doc_id""")
def evidence_full_outer(spark, sf_dir):
    """Which of three families of evidence each id has."""
    has = lambda df, letter: df.select("doc_id").distinct().withColumn(letter, F.lit(letter))
    d = has(table(spark, sf_dir, "documents").where("doc_id % 2 = 0"), "d")
    marks = has(table(spark, sf_dir, "labels"), "l")
    m = has(table(spark, sf_dir, "benchmark").select((F.col("item_id") * 5).alias("doc_id")), "m")
    return d.join(marks, "doc_id", "full").join(m, "doc_id", "full").select("doc_id", F.concat(*(F.coalesce(x, F.lit("-")) for x in "dlm")).alias("families"))


@query("""SELECT source, count(*) AS n, count(l.doc_id) AS covered, bool_and(l.doc_id IS NOT NULL) AS complete, round(count(l.doc_id) * 1.0 / count(*), 6) AS share
FROM documents d LEFT JOIN (SELECT DISTINCT doc_id FROM labels) l USING (doc_id) GROUP BY source""")
def coverage_by_source(spark, sf_dir):
    marks = table(spark, sf_dir, "labels").select("doc_id").distinct().withColumn("has", F.lit(True))
    joined = table(spark, sf_dir, "documents").select("doc_id", "source").join(marks, "doc_id", "left")
    has = F.col("has").isNotNull()
    return joined.groupBy("source").agg(F.count("*").alias("n"), F.count("has").alias("covered"), F.every(has).alias("complete"), F.round(F.count("has") / F.count("*"), 6).alias("share"))


@query("""WITH s AS (SELECT CAST(ts AS DATE) AS day, event_id, value FROM events WHERE event_type = 'signup'), b AS (SELECT day, event_id, row_number() OVER (PARTITION BY day ORDER BY value DESC, event_id) AS k FROM s)
SELECT o_orderkey, e.event_id, datediff('day', e.day, CAST(o_orderdate AS DATE)) AS age FROM orders o LEFT JOIN LATERAL (SELECT event_id, day FROM b WHERE k = 1 AND b.day <= CAST(o.o_orderdate AS DATE) AND b.day >= CAST(o.o_orderdate AS DATE) - 7 ORDER BY day DESC LIMIT 1) e ON true""")
def asof_prior_summary(spark, sf_dir):
    events = table(spark, sf_dir, "events").where("event_type = 'signup'").select(F.to_date("ts").alias("day"), "event_id", "value")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("day"))
    return ops.asof_prior(orders, events, "day", 7, F.desc("value"), F.col("event_id")).select("o_orderkey", "event_id", F.col("age").cast("long").alias("age"))


@query("""WITH l AS (SELECT l_orderkey, list(l_partkey ORDER BY l_linenumber, l_partkey, l_suppkey) AS p, list(l_suppkey ORDER BY l_linenumber, l_partkey, l_suppkey) AS s FROM lineitem GROUP BY 1),
z AS (SELECT l_orderkey, p[i] AS part, s[i] AS supp, i AS pos FROM l, LATERAL (SELECT unnest(range(1, len(p) + 1)) AS i)) SELECT l_orderkey, CAST(pos AS BIGINT) AS pos, part, supp FROM z""")
def positional_alignment(spark, sf_dir):
    ordered = lambda c: F.transform(F.sort_array(F.collect_list(F.struct("l_linenumber", "l_partkey", "l_suppkey"))), lambda x: x[c])
    arrays = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(ordered("l_partkey").alias("part"), ordered("l_suppkey").alias("supp"))
    each = arrays.select("l_orderkey", F.posexplode(F.arrays_zip("part", "supp")).alias("pos", "x"))
    return each.select("l_orderkey", (F.col("pos") + 1).cast("long").alias("pos"), "x.part", "x.supp")


@query("""WITH l AS (SELECT l_orderkey, list(l_returnflag ORDER BY l_linenumber, l_partkey, l_returnflag) AS f FROM lineitem GROUP BY 1)
SELECT l_orderkey, CAST(len(list_filter(range(1, len(f)), lambda i: f[i] = 'N' AND f[i + 1] = 'N')) AS BIGINT) AS runs FROM l""")
def subsequence_match(spark, sf_dir):
    flags = F.transform(F.sort_array(F.collect_list(F.struct("l_linenumber", "l_partkey", "l_returnflag"))), lambda x: x["l_returnflag"])
    arrays = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(flags.alias("f"))
    return arrays.select("l_orderkey", ops.contains_run(F.col("f"), F.array(F.lit("N"), F.lit("N"))).alias("runs"))


@query("""WITH a AS (SELECT DISTINCT p_type AS wanted FROM part), b AS (SELECT DISTINCT p_type AS name FROM part WHERE p_partkey % 4 = 0),
ka AS (SELECT wanted, 1 AS r, lower(wanted) AS k FROM a UNION ALL SELECT wanted, 2, string_split(lower(wanted), ' ')[-1] FROM a UNION ALL SELECT wanted, 3, unnest(list_distinct(string_split(lower(wanted), ' '))) FROM a),
kb AS (SELECT name, 1 AS r, lower(name) AS k FROM b UNION ALL SELECT name, 2, string_split(lower(name), ' ')[-1] FROM b UNION ALL SELECT name, 3, unnest(list_distinct(string_split(lower(name), ' '))) FROM b),
h AS (SELECT wanted, r, name, row_number() OVER (PARTITION BY wanted ORDER BY r, name) AS n FROM ka JOIN kb USING (r, k)) SELECT wanted, CAST(r AS BIGINT) AS match_rank, name FROM h WHERE n = 1""")
def ranked_tag_match(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    return ops.ranked_match(part.select(F.col("p_type").alias("wanted")), part.where("p_partkey % 4 = 0").select(F.col("p_type").alias("name")), "wanted", "name")


@query("""WITH u AS (SELECT DISTINCT regexp_extract(url, '://([^?#]+)', 1) AS p FROM pages), s AS (SELECT list_filter(string_split(p, '/'), lambda x: x <> '') AS p FROM u),
n AS (SELECT array_to_string(p[1:d], '/') AS path, d, d = len(p) AS leaf FROM s, LATERAL (SELECT unnest(range(1, len(p) + 1)) AS d))
SELECT path, CASE WHEN max(d) > 1 THEN regexp_replace(path, '/[^/]*$', '') END AS parent, CAST(max(d) AS BIGINT) AS depth, CASE WHEN bool_and(leaf) THEN 'file' ELSE 'directory' END AS kind FROM n GROUP BY path""")
def path_hierarchy(spark, sf_dir):
    paths = table(spark, sf_dir, "pages").select(F.regexp_extract("url", "://([^?#]+)", 1).alias("path")).distinct()
    return ops.path_nodes(paths, "path")


@query("""WITH RECURSIVE n AS (SELECT doc_id AS id, CASE WHEN doc_id = 0 THEN NULL ELSE doc_id // 10 END AS parent FROM documents),
w AS (SELECT id, parent, 0 AS depth, CAST(id AS VARCHAR) AS trail FROM n WHERE parent IS NULL UNION ALL SELECT n.id, n.parent, w.depth + 1, w.trail || '/' || n.id FROM n JOIN w ON n.parent = w.id WHERE n.id <> 0)
SELECT id, coalesce(parent, -1) AS parent, CAST(depth AS BIGINT) AS depth, trail FROM w""")
def block_tree_walk(spark, sf_dir):
    """A tree walked from its root, with depth and trail."""
    parent = F.when(F.col("doc_id") == 0, None).otherwise(F.floor(F.col("doc_id") / 10))
    nodes = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), parent.cast("long").alias("parent"))
    return trees.walk(nodes, "id", "parent", trail=True).select("id", F.coalesce("parent", F.lit(-1)).alias("parent"), "depth", "trail")


PARENT_SQL = """CASE WHEN doc_id = 0 THEN NULL WHEN doc_id % 97 = 13 THEN -5 WHEN doc_id % 50 = 41 THEN doc_id + 1 WHEN doc_id % 50 = 42 THEN doc_id - 1 WHEN doc_id BETWEEN 101 AND 180 THEN doc_id - 1 ELSE doc_id // 10 END"""


@query(f"""WITH RECURSIVE n AS (SELECT doc_id AS id, {PARENT_SQL} AS parent FROM documents),
w AS (SELECT id, id AS root, 0::BIGINT AS depth, CASE WHEN parent IS NULL THEN 'ok' ELSE 'orphan' END AS e FROM n WHERE parent IS NULL OR parent NOT IN (SELECT id FROM n)
UNION ALL SELECT n.id, w.root, w.depth + 1, w.e FROM w JOIN n ON n.parent = w.id)
SELECT n.id, n.parent, w.root, w.depth, CASE WHEN w.id IS NULL THEN 'cycle' WHEN e = 'orphan' THEN 'orphan' WHEN depth > 30 THEN 'too_deep' ELSE 'ok' END AS outcome FROM n LEFT JOIN w ON w.id = n.id""")
def tree_outcomes(spark, sf_dir):
    """A parent table with cycles, missing parents and a long branch: each node's root, depth and outcome."""
    d = F.col("doc_id")
    parent = (
        F.when(d == 0, None).when(d % 97 == 13, -5).when(d % 50 == 41, d + 1).when(d % 50 == 42, d - 1).when(d.between(101, 180), d - 1).otherwise(F.floor(d / 10))
    )
    return trees.walk(table(spark, sf_dir, "documents").select(d.alias("id"), parent.cast("long").alias("parent")), "id", "parent")


CHAIN_SQL = """SELECT user_id, event_id, number, CASE WHEN event_id % 401 = 7 THEN 'lost' WHEN event_id % 307 = 9 THEN lag(own, 2) OVER w WHEN event_id % 211 = 5 THEN lead(own) OVER w ELSE lag(own) OVER w END AS before, own
FROM (SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY event_id) + (event_id % 503 = 11)::INT AS number, md5(user_id || ':' || event_id) AS own FROM events) WINDOW w AS (PARTITION BY user_id ORDER BY event_id)"""


@query(f"""WITH RECURSIVE r AS ({CHAIN_SQL}), f AS (SELECT before FROM r WHERE before IS NOT NULL GROUP BY before HAVING count(*) > 1), a AS (SELECT user_id, number FROM r GROUP BY ALL HAVING count(*) > 1),
m AS (SELECT r.*, r.before IN (SELECT before FROM f) AND r.before IS NOT NULL OR (r.user_id, r.number) IN (SELECT user_id, number FROM a) AS forked, coalesce(r.number <> p.number + 1, false) AS misnumbered FROM r LEFT JOIN r p ON p.own = r.before),
w AS (SELECT own, 0::BIGINT AS depth, forked, misnumbered, before IS NOT NULL AS gap FROM m WHERE before IS NULL OR before NOT IN (SELECT own FROM m)
UNION ALL SELECT m.own, w.depth + 1, w.forked OR m.forked, w.misnumbered OR m.misnumbered, w.gap FROM w JOIN m ON m.before = w.own)
SELECT m.own AS receipt, m.user_id AS chain, m.number AS sequence, w.depth, CASE WHEN w.own IS NULL THEN 'cycle' WHEN gap THEN 'gap' WHEN w.forked THEN 'fork' WHEN w.misnumbered THEN 'misnumbered' ELSE 'admitted' END AS outcome
FROM m LEFT JOIN w ON w.own = m.own""")
def receipt_chains(spark, sf_dir):
    """Receipts of each user that name the one before them, some lost, forked, turned round or misnumbered."""
    from pyspark.sql import Window

    w, e = Window.partitionBy("user_id").orderBy("event_id"), F.col("event_id")
    own = lambda c: F.when(c.isNotNull(), F.md5(F.concat_ws(":", "user_id", c)))
    number = F.row_number().over(w) + (e % 503 == 11).cast("int")
    near = F.when(e % 307 == 9, F.lag("event_id", 2).over(w)).when(e % 211 == 5, F.lead("event_id").over(w)).otherwise(F.lag("event_id").over(w))
    # receipts are hashed behind the window, which sorts numbers only
    rows = table(spark, sf_dir, "events").select("user_id", "event_id").select("user_id", "event_id", near.alias("near"), number.cast("long").alias("number"))
    made = rows.select("user_id", own(e).alias("receipt"), F.when(e % 401 == 7, "lost").otherwise(own(F.col("near"))).alias("before"), "number")
    return trees.admitted_chain(made, "receipt", "before", "number", "user_id")


@query("""WITH r AS (SELECT source, doc_id, md5(text) AS v FROM documents WHERE doc_id % 6 = 0), e AS (SELECT doc_id, md5(CASE WHEN doc_id % 18 = 0 THEN text || ' ' ELSE text END) AS v FROM documents WHERE doc_id % 4 = 0)
SELECT r.source, count(*) AS expected, count(e.doc_id) AS observed, count(*) FILTER (WHERE e.v = r.v) AS equal, count(*) FILTER (WHERE e.v = r.v) = count(*) AS verified FROM r LEFT JOIN e USING (doc_id) GROUP BY r.source""")
def read_back(spark, sf_dir):
    """Expected rows against what a target shows."""
    docs = table(spark, sf_dir, "documents")
    expected = docs.where("doc_id % 6 = 0").select("source", "doc_id", F.md5("text").alias("v"))
    seen = docs.where("doc_id % 4 = 0").select("doc_id", F.md5(F.when(F.col("doc_id") % 18 == 0, F.concat("text", F.lit(" "))).otherwise(F.col("text"))).alias("w"))
    equal = F.count_if(F.col("v") == F.col("w"))
    return expected.join(seen, "doc_id", "left").groupBy("source").agg(F.count("*").alias("expected"), F.count("w").alias("observed"), equal.alias("equal"), (equal == F.count("*")).alias("verified"))


@query("""WITH n AS (SELECT DISTINCT lower(p_brand) || '/' || p_type AS name FROM part), t(tag) AS (VALUES ('brand#1/ECONOMY'), ('economy'), ('Small'), ('rand#2'), ('nowhere'), ('promo')),
h AS (SELECT tag, name, CASE WHEN lower(name) = lower(tag) THEN 1 WHEN string_split(lower(name), '/')[-1] = lower(tag) THEN 2 WHEN contains(lower(name), lower(tag)) THEN 3 ELSE 4 END AS r FROM t, n),
k AS (SELECT *, row_number() OVER (PARTITION BY tag ORDER BY r, name) AS k FROM h) SELECT tag, CAST(r AS BIGINT) AS match_rank, name FROM k WHERE k = 1""")
def tag_resolution(spark, sf_dir):
    """Requested tags against a tag tree: exact, last part, part of a name, else the first."""
    names = table(spark, sf_dir, "part").select(F.concat(F.lower("p_brand"), F.lit("/"), F.col("p_type")).alias("name"))
    asked = spark.createDataFrame([("brand#1/ECONOMY",), ("economy",), ("Small",), ("rand#2",), ("nowhere",), ("promo",)], "tag string")
    return ops.resolved_tags(asked, names, "tag", "name")


@query("""WITH c AS (SELECT source, lang, count(*) // 3 AS s FROM documents GROUP BY ALL), m AS (SELECT source, max(s) AS top FROM c GROUP BY source),
a AS (SELECT source, count(*) FILTER (WHERE s = top) AS n, min(lang) FILTER (WHERE s = top) AS best, count(*) FILTER (WHERE starts_with(lang, 'e')) AS k, min(lang) FILTER (WHERE starts_with(lang, 'e')) AS word FROM c JOIN m USING (source) GROUP BY source)
SELECT source, CASE WHEN n = 1 THEN 'scored' WHEN k = 1 THEN 'keyword' ELSE 'ambiguous' END AS outcome, CASE WHEN n = 1 THEN best WHEN k = 1 THEN word END AS choice FROM a""")
def property_choice(spark, sf_dir):
    candidates = table(spark, sf_dir, "documents").groupBy("source", "lang").agg(F.floor(F.count("*") / 3).alias("s"))
    return ops.unique_best(candidates, "source", "lang", "s", F.startswith("lang", F.lit("e")))


@query("""WITH m AS (SELECT md5(text) AS identity, count(*) AS n, min(doc_id) AS doc_id FROM documents WHERE doc_id % 3 <> 0 AND text IS NOT NULL GROUP BY 1)
SELECT d.doc_id, CASE WHEN m.n IS NULL THEN 'absent' WHEN m.n > 1 THEN 'conflict' ELSE 'indexed' END AS outcome, CASE WHEN m.n = 1 THEN m.doc_id END AS place FROM documents d LEFT JOIN m ON md5(d.text) = m.identity WHERE d.doc_id % 2 = 0""")
def mirror_lookup(spark, sf_dir):
    """Records looked up in a mirror by identity; copies in the mirror are conflicts."""
    docs = table(spark, sf_dir, "documents").select("doc_id", F.md5("text").alias("identity"))
    index = ops.unique_index(docs.where("doc_id % 3 <> 0").select("identity", F.col("doc_id").alias("place")), "identity", "place")
    return docs.where("doc_id % 2 = 0").join(index, "identity", "left").select("doc_id", F.coalesce("outcome", F.lit("absent")).alias("outcome"), "place")


@query("""WITH o AS (SELECT source, lang AS owner, 1 AS p FROM documents WHERE doc_id % 50 = 0 UNION ALL SELECT source, 'en', 2 FROM documents WHERE doc_id % 50 = 1)
SELECT source, CASE WHEN min(owner) = max(owner) THEN min(owner) END AS owner, CASE WHEN min(owner) = max(owner) THEN 'owned' ELSE 'rejected' END AS outcome FROM o GROUP BY source""")
def owner_overlap(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    maps = docs.where("doc_id % 50 = 0").select("source", F.col("lang").alias("owner"), F.lit(1).alias("p")).unionByName(docs.where("doc_id % 50 = 1").select("source", F.lit("en").alias("owner"), F.lit(2).alias("p")))
    return ops.merged_owners(maps, "source", "owner", "p")


@query("""WITH s AS (SELECT doc_id, md5(text) AS v, lang FROM documents), d AS (SELECT doc_id, CASE WHEN doc_id % 14 = 0 THEN md5(text || 'x') ELSE md5(text) END AS v, CASE WHEN doc_id % 15 = 0 THEN 'xx' ELSE lang END AS lang FROM documents WHERE doc_id % 9 <> 0)
SELECT s.doc_id, CASE WHEN d.doc_id IS NULL THEN 'detail_missing' WHEN s.v <> d.v OR s.lang <> d.lang THEN 'detail_differs' ELSE 'ok' END AS outcome FROM s LEFT JOIN d USING (doc_id)""")
def detail_consistency(spark, sf_dir):
    """Listed rows with their details: those that disagree or lack one go to the holds."""
    docs = table(spark, sf_dir, "documents")
    listed = docs.select("doc_id", F.md5("text").alias("v"), "lang")
    edited = F.when(F.col("doc_id") % 14 == 0, F.md5(F.concat("text", F.lit("x")))).otherwise(F.md5("text"))
    details = docs.where("doc_id % 9 <> 0").select("doc_id", edited.alias("v"), F.when(F.col("doc_id") % 15 == 0, "xx").otherwise(F.col("lang")).alias("lang"))
    good, held = paged.with_details(listed, details, "doc_id", "v", "lang")
    return good.select("doc_id", F.lit("ok").alias("outcome")).unionByName(held.select("doc_id", F.col("reason").alias("outcome")))


@query("""WITH p AS (SELECT event_id, (row_number() OVER (ORDER BY event_id) - 1) // 20 AS page FROM events), m AS (SELECT max(page) + 1 AS n FROM p)
SELECT event_id, page, event_id % 20 = 4 AND page IN (7 % n, 8 % n, 9 % n) AS audited FROM p, m WHERE page < 3 OR page IN (7 % n, 8 % n, 9 % n)""")
def window_scan(spark, sf_dir):
    """A bounded scan: the three newest pages, three after a rotating cursor, and one row of each of these to audit."""
    pages = paged.pages_of(table(spark, sf_dir, "events").select("event_id"), "event_id", 20)
    found = paged.scan_window(pages, "page", 7)
    last = pages.agg((F.max("page") + 1).alias("n"))
    turned = F.exists(F.array(*(F.lit(7 + i) % F.col("n") for i in range(3))), lambda x: x == F.col("page"))
    return found.crossJoin(F.broadcast(last)).select("event_id", "page", ((F.col("event_id") % 20 == 4) & turned).alias("audited"))


@query("""WITH s AS (SELECT doc_id, md5(text) AS v FROM documents WHERE doc_id % 11 <> 0), t AS (SELECT doc_id, md5(CASE WHEN doc_id % 7 = 0 THEN text || 'x' ELSE text END) AS v, doc_id % 20 AS age FROM documents WHERE doc_id % 10 <> 0),
m AS (SELECT doc_id, CASE WHEN doc_id % 13 = 0 THEN 2 ELSE 1 END AS n FROM documents WHERE doc_id % 5 <> 1)
SELECT s.doc_id, CASE WHEN m.n > 1 THEN 'conflict' WHEN t.doc_id IS NULL THEN 'detail_required' WHEN t.v <> s.v THEN 'changed' WHEN m.n IS NULL THEN 'detail_required' WHEN t.age >= 15 THEN 'recheck' ELSE 'unchanged' END AS outcome
FROM s LEFT JOIN t USING (doc_id) LEFT JOIN m USING (doc_id)""")
def list_classes(spark, sf_dir):
    """A list scan against state and mirrors: unchanged rows take the fast path, others need detail or are conflicts."""
    docs, d = table(spark, sf_dir, "documents"), F.col("doc_id")
    scan = docs.where("doc_id % 11 <> 0").select("doc_id", F.md5("text").alias("v"))
    state = docs.where("doc_id % 10 <> 0").select("doc_id", F.md5(F.when(d % 7 == 0, F.concat("text", F.lit("x"))).otherwise(F.col("text"))).alias("held"), (d % 20).alias("age"))
    mirrors = docs.where("doc_id % 5 <> 1").select("doc_id", F.when(d % 13 == 0, 2).otherwise(1).alias("n"))
    outcome = (
        F.when(F.col("n") > 1, "conflict").when(F.col("held").isNull(), "detail_required").when(F.col("held") != F.col("v"), "changed").when(F.col("n").isNull(), "detail_required")
        .when(F.col("age") >= 15, "recheck").otherwise("unchanged")
    )
    return scan.join(state, "doc_id", "left").join(mirrors, "doc_id", "left").select("doc_id", outcome.alias("outcome"))
