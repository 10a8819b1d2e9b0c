"""Queries over chains, manifests, appended documents, budgets and JSON without a schema."""

from __future__ import annotations

from pyspark.sql import functions as F

from siltworks.functions import front_matter
from siltworks.operators import manifests, proposals, ranking, trees, variants
from siltworks.plans.registry import query, table
from siltworks.sources import paged

#: Metadata of pages in shapes that differ from row to row; @ is the url, ~ a signature.
SHAPES = [
    '{"properties":{"Files":{"type":"files","files":[{"type":"file","name":"a","file":{"url":"@~","expiry_time":"t~"}}]}},"cover":null,"icon":{"type":"emoji","emoji":"x"},"last_edited":"~"}',
    '{"properties":{"Deep":[[[{"file":{"expiry_time":"t~","url":"@~","n":[1.50,true,{}]},"type":"file"}]],[]],"odd key":"a\\"b"},"cover":{"type":"external","file":{"url":"@","expiry_time":"t"}},"icon":[]}',
    '{"properties":"@","cover":{"type":"file","file":"@"},"icon":{"type":["file"],"file":{"expiry_time":"@"}}}',
    '{"properties":{"a":1,"a":2}}',
    '[{"type":"file","file":{"url":"@","expiry_time":"~"}}]',
]
SHAPE_SQL = "CASE page_id % 5 " + " ".join(f"WHEN {i} THEN '{s}'" for i, s in enumerate(SHAPES)) + " END"


@query(f"""WITH d AS (SELECT page_id, unnest([1, 2]) AS version FROM pages), t AS (SELECT d.page_id, version, replace(replace({SHAPE_SQL.replace('page_id', 'd.page_id')}, '@', url), '~', '?s=' || version) AS j FROM d JOIN pages p ON p.page_id = d.page_id),
n AS (SELECT t.page_id, version, n.* FROM t, json_tree(CASE WHEN t.page_id % 5 = 3 THEN 'null' ELSE j END) n),
f AS (SELECT c.*, p.key = 'file' AND g.type = 'OBJECT' AND k.atom::VARCHAR = '"file"' AS in_file FROM n c LEFT JOIN n p ON p.page_id = c.page_id AND p.version = c.version AND p.id = c.parent
  LEFT JOIN n g ON g.page_id = c.page_id AND g.version = c.version AND g.id = p.parent LEFT JOIN n k ON k.page_id = c.page_id AND k.version = c.version AND k.parent = g.id AND k.key = 'type'),
l AS (SELECT page_id, version, fullkey || '=' || CASE WHEN in_file AND key = 'url' AND type = 'VARCHAR' THEN regexp_replace(value::VARCHAR, '[?#].*"$', '"') WHEN value::VARCHAR = '1.50' THEN '1.5' ELSE value::VARCHAR END AS line FROM f
  WHERE (type NOT IN ('OBJECT', 'ARRAY') OR value::VARCHAR IN ('{{}}', '[]')) AND NOT coalesce(in_file AND key = 'expiry_time', false) AND (starts_with(fullkey, '$.properties') OR starts_with(fullkey, '$.cover') OR starts_with(fullkey, '$.icon'))),
h AS (SELECT page_id, version, sha256(string_agg(line, chr(10) ORDER BY line)) AS fingerprint, count(*) AS leaves FROM l GROUP BY ALL)
SELECT p.page_id, a.fingerprint, coalesce(a.leaves, 0) AS leaves, coalesce(a.fingerprint = b.fingerprint, false) AS same_after_refresh FROM pages p LEFT JOIN h a ON a.page_id = p.page_id AND a.version = 1 LEFT JOIN h b ON b.page_id = p.page_id AND b.version = 2""")
def metadata_fingerprint(spark, sf_dir):
    """Fingerprints of metadata in mixed shapes, before and after the signed URLs in it were renewed."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url", F.explode(F.array(F.lit(1), F.lit(2))).alias("version"))
    shape = F.element_at(F.array(*(F.lit(s) for s in SHAPES)), (F.col("page_id") % len(SHAPES) + 1).cast("int"))
    signature = F.concat(F.lit("?s="), F.col("version").cast("string"))
    made = pages.select(F.concat_ws(":", "page_id", "version").alias("id"), "page_id", "version", F.replace(F.replace(shape, F.lit("@"), F.col("url")), F.lit("~"), signature).alias("j"))
    found = made.join(variants.metadata_fingerprints(made, "id", "j"), "id", "left")
    of = lambda v, c: F.max(F.when(F.col("version") == v, F.col(c)))
    both = found.groupBy("page_id").agg(of(1, "fingerprint").alias("fingerprint"), of(2, "fingerprint").alias("after"), of(1, "leaves").alias("leaves"))
    return both.select("page_id", "fingerprint", F.coalesce("leaves", F.lit(0)).alias("leaves"), F.coalesce(F.col("fingerprint") == F.col("after"), F.lit(False)).alias("same_after_refresh"))


@query("""WITH a AS (SELECT row_number() OVER (ORDER BY doc_id) AS place, doc_id, md5(text) AS v FROM documents), x AS (SELECT doc_id, text, CASE doc_id WHEN 155 THEN 156.0 WHEN 156 THEN 155.0 WHEN 180 THEN NULL ELSE doc_id END AS o FROM documents),
b AS (SELECT row_number() OVER (ORDER BY o) AS place, doc_id, md5(text) AS v FROM x WHERE o IS NOT NULL), d AS (SELECT coalesce(a.place, b.place) AS place, a.doc_id AS l, b.doc_id AS r FROM a FULL JOIN b USING (place) WHERE a.v IS DISTINCT FROM b.v OR a.doc_id IS DISTINCT FROM b.doc_id),
s AS (SELECT 'moved' AS manifest, (SELECT count(*) FROM a) AS n_left, (SELECT count(*) FROM b) AS n_right, min(place) AS first_difference, arg_min(l, place) AS l, arg_min(r, place) AS r FROM d UNION ALL SELECT 'same', (SELECT count(*) FROM a), (SELECT count(*) FROM a), NULL, NULL, NULL)
SELECT manifest, first_difference IS NULL AS equal, n_left, n_right, first_difference, l AS left_id, r AS right_id FROM s""")
def manifest_order(spark, sf_dir):
    """A reviewed list of documents against the list found: two rows swapped and one gone, and a copy."""
    docs, d = table(spark, sf_dir, "documents"), F.col("doc_id")
    reviewed = docs.select(d.alias("o"), "doc_id", F.md5("text").alias("v"))
    moved = docs.select(F.when(d == 155, 156).when(d == 156, 155).when(d != 180, d).alias("o"), "doc_id", F.md5("text").alias("v")).where("o is not null")
    out = []
    for name, found in (("moved", moved), ("same", reviewed)):
        got = manifests.compare_ordered(reviewed, found, "o", ["doc_id", "v"])
        of = lambda c: F.get_json_object(c, "$.doc_id").cast("long")
        out.append(got.select(F.lit(name).alias("manifest"), "equal", "n_left", "n_right", "first_difference", of("left_row").alias("left_id"), of("right_row").alias("right_id")))
    return out[0].unionByName(out[1])


@query(r"""WITH p AS (SELECT page_id, regexp_extract(url, '://[^/?#]*/([^?#]*)', 1) AS path, strlen(html) AS size FROM pages)
SELECT page_id, path, CASE WHEN regexp_matches(path, '(^|/)\.\.?(/|$)|^/|\\') OR NOT (starts_with(path, 'en/') OR starts_with(path, 'fr/')) THEN 'scope' WHEN size > 4000 THEN 'size' END AS reason FROM p""")
def publication_scope(spark, sf_dir):
    """Paths that may be published: under an allowed folder and of a size."""
    pages = table(spark, sf_dir, "pages").select("page_id", F.regexp_extract("url", "://[^/?#]*/([^?#]*)", 1).alias("path"), F.octet_length("html").alias("size"))
    return manifests.outside_scope(pages, "path", "size", ["en/", "fr/"], 4000).select("page_id", "path", "reason")


@query("""WITH RECURSIVE l AS (SELECT doc_id, unnest(range(len(t))) AS pos, unnest(t) AS line, len(t) AS n FROM (SELECT doc_id, string_split(text, ' ') AS t FROM documents WHERE text IS NOT NULL)),
s AS (SELECT doc_id, pos, CASE WHEN doc_id % 9 = 4 AND pos = n // 3 THEN 'edited' ELSE line END AS line FROM l WHERE pos < CASE doc_id % 4 WHEN 0 THEN 0 WHEN 1 THEN n // 2 WHEN 2 THEN n ELSE n - 1 END
  UNION ALL SELECT DISTINCT doc_id, n, 'more' FROM l WHERE doc_id % 20 = 2),
j AS (SELECT coalesce(l.doc_id, s.doc_id) AS doc_id, coalesce(l.pos, s.pos) AS pos, l.line AS w, s.line AS s, strlen(l.line) AS size FROM l FULL JOIN s ON s.doc_id = l.doc_id AND s.pos = l.pos),
d AS (SELECT doc_id, count(w) AS n, count(s) AS seen, min(pos) FILTER (WHERE s IS NOT NULL AND w IS DISTINCT FROM s) AS bad, max(size) FILTER (WHERE s IS NULL) AS largest FROM j GROUP BY doc_id),
o AS (SELECT *, CASE WHEN bad IS NOT NULL THEN 'modified' WHEN doc_id % 10 = 1 AND seen < n // 2 + 5 THEN 'reconcile' WHEN seen = n THEN 'complete' WHEN largest > 300 THEN 'too_large' ELSE 'append' END AS outcome FROM d),
r AS (SELECT j.doc_id, j.pos, j.size, row_number() OVER (PARTITION BY j.doc_id ORDER BY j.pos) AS k FROM j JOIN o ON o.doc_id = j.doc_id AND outcome = 'append' WHERE s IS NULL),
b AS (SELECT doc_id, k, 1 AS items, size, 0 AS batch FROM r WHERE k = 1 UNION ALL SELECT r.doc_id, r.k, CASE WHEN b.items >= 100 OR b.size + r.size > 300 THEN 1 ELSE b.items + 1 END, CASE WHEN b.items >= 100 OR b.size + r.size > 300 THEN r.size ELSE b.size + r.size END,
  b.batch + CASE WHEN b.items >= 100 OR b.size + r.size > 300 THEN 1 ELSE 0 END FROM b JOIN r ON r.doc_id = b.doc_id AND r.k = b.k + 1),
e AS (SELECT b.doc_id, batch, min(pos) || '-' || max(pos) AS ends FROM b JOIN r ON r.doc_id = b.doc_id AND r.k = b.k GROUP BY ALL), x AS (SELECT doc_id, string_agg(ends, ',' ORDER BY batch) AS batches FROM e GROUP BY doc_id)
SELECT o.doc_id, coalesce(bad, least(seen, n)) AS shared, CASE WHEN outcome = 'append' THEN n - seen ELSE 0 END AS todo, outcome, batches FROM o LEFT JOIN x ON x.doc_id = o.doc_id""")
def append_with_prefix(spark, sf_dir):
    """Documents appended word by word: where each goes on, and those held because a word was edited or a response was lost."""
    docs = table(spark, sf_dir, "documents").where("text is not null").select("doc_id", F.split("text", " ").alias("t")).withColumn("n", F.size("t"))
    words = docs.select("doc_id", "n", F.posexplode("t").alias("at", "line")).withColumn("size", F.octet_length("line"))
    d, n, at = F.col("doc_id"), F.col("n"), F.col("at")
    half = F.floor(n / 2)
    there = words.where(at < F.when(d % 4 == 0, 0).when(d % 4 == 1, half).when(d % 4 == 2, n).otherwise(n - 1)).withColumn("line", F.when((d % 9 == 4) & (at == F.floor(n / 3)), "edited").otherwise(F.col("line")))
    seen = there.select("doc_id", "at", "line").unionByName(docs.where(d % 20 == 2).select("doc_id", n.alias("at"), F.lit("more").alias("line")))
    intents = docs.where(d % 10 == 1).select("doc_id", (half + 5).alias("up_to"))
    plan = manifests.append_plan(words, seen, intents, "doc_id", "at", "line", "size", bytes_=300)
    ends = F.transform("batches", lambda b: F.concat(b["first"].cast("string"), F.lit("-"), b["last"].cast("string")))
    return plan.select("doc_id", "shared", "todo", "outcome", F.array_join(ends, ",").alias("batches"))


@query("""WITH k AS (SELECT doc_id, source, CASE WHEN doc_id % 4 = 0 THEN 'audit' WHEN doc_id % 4 = 1 AND source <> 'src3' THEN 'deferred' ELSE 'fresh' END AS kind FROM documents),
c AS (SELECT source, count(*) FILTER (WHERE kind = 'audit') AS a, count(*) FILTER (WHERE kind = 'deferred') AS d, count(*) FILTER (WHERE kind = 'fresh') AS f FROM k GROUP BY source),
s AS (SELECT *, least(a, 5) AS sa, 20 - least(a, 5) AS ch FROM c), t AS (SELECT *, least(d, ch - least(25, greatest(1, ch // 3))) AS sd FROM s), u AS (SELECT *, least(f, ch - sd) AS sf FROM t),
r AS (SELECT *, row_number() OVER (PARTITION BY source, kind ORDER BY doc_id) AS rank FROM k)
SELECT r.source, doc_id, CASE WHEN rank <= CASE kind WHEN 'audit' THEN sa WHEN 'deferred' THEN sd ELSE sf END THEN kind ELSE 'waits' END AS slot FROM r JOIN u ON u.source = r.source
WHERE kind <> 'audit' OR rank <= sa""")
def budget_with_backlog(spark, sf_dir):
    """Twenty reads of each source: audits, deferred and fresh changes; slots that one kind leaves go to the next, the rest waits."""
    d = F.col("doc_id")
    kind = F.when(d % 4 == 0, "audit").when((d % 4 == 1) & (F.col("source") != "src3"), "deferred").otherwise("fresh")
    taken, waiting = manifests.share_budget(table(spark, sf_dir, "documents").select("doc_id", "source", kind.alias("kind"), d.alias("o")), "source", "doc_id", "kind", "o", budget=20, reserve=5)
    return taken.select("source", "doc_id", "slot").unionByName(waiting.select("source", "doc_id", F.lit("waits").alias("slot")))


#: Lines of heads by number; ~ is the source (fixed values).
HEAD_LINES = ['source: "~"', "lang: en", "lang: 1", "  - ~", "~", "", "# note", "n: {\"a\": [1]}", "note_id: 'x'", "note_id: |"]
HEAD_SQL = "[" + ", ".join("'" + x.replace("'", "''") + "'" for x in HEAD_LINES) + "]"


@query(f"""WITH d AS (SELECT doc_id, list_transform([doc_id % 10, doc_id // 10 % 10, doc_id // 100 % 10], lambda k: replace({HEAD_SQL}[k + 1], '~', coalesce(source, ''))) AS x FROM documents),
k AS (SELECT doc_id, x, list_transform(x, lambda l: split_part(l, ':', 1)) AS keys, list_transform(x, lambda l: trim(l[instr(l, ':') + 1:])) AS vals,
  list_filter(x, lambda l: NOT starts_with(l, '  ')) AS tops, NOT starts_with(x[1], '  ') AS flush FROM d),
j AS (SELECT *, list_bool_and(list_transform(x, lambda l: contains(l, ': ') AND coalesce(json_valid(l[instr(l, ': ') + 2:]), false))) AS all_json FROM k)
SELECT doc_id, CASE WHEN all_json AND len(list_distinct(keys)) = 3 THEN 'ok' ELSE 'malformed' END AS strict_json,
CASE WHEN NOT flush OR NOT list_bool_and(list_transform(tops, lambda l: contains(l, ': '))) THEN 'unknown' WHEN len(list_distinct(list_transform(tops, lambda l: split_part(l, ': ', 1)))) < len(tops) THEN 'duplicate' ELSE 'ok' END AS continued,
CASE WHEN list_bool_and(list_transform(x, lambda l: contains(l, ':') AND NOT regexp_matches(l, '^(\\s|#|$)'))) AND len(list_distinct(keys)) = 3 AND NOT list_contains(x, 'note_id: |') THEN 'ok' ELSE 'malformed' END AS legacy FROM j""")
def front_matter_dialects(spark, sf_dir):
    """Heads of three lines in three strict dialects: what each makes of them."""
    d, lines = F.col("doc_id"), F.array(*(F.lit(x) for x in HEAD_LINES))
    chosen = [F.replace(F.get(lines, (F.floor(d / n) % 10).cast("int")), F.lit("~"), F.coalesce("source", F.lit(""))) for n in (1, 10, 100)]
    made = F.concat(F.lit("---\n"), F.concat_ws("\n", *chosen), F.lit("\n---\n"), F.coalesce("text", F.lit("")))
    rows = table(spark, sf_dir, "documents").select("doc_id", made.alias("t"))
    return rows.select("doc_id", *(getattr(front_matter, n)(F.col("t"))["outcome"].alias(n) for n in ("strict_json", "continued", "legacy")))


FILES_SQL = """o AS (SELECT 'a/' || user_id AS path, event_id AS start, NULL::VARCHAR AS before FROM events WHERE event_id % 5 = 0 UNION ALL SELECT CASE event_id % 5 WHEN 1 THEN 'b/' ELSE 'c/' END || user_id, event_id, CASE event_id % 5 WHEN 1 THEN 'a/' ELSE 'b/' END || user_id FROM events WHERE event_id % 5 IN (1, 2)),
m AS (SELECT path, start AS t, true AS comes, before FROM o UNION ALL SELECT before, start, false, NULL FROM o WHERE before IS NOT NULL), s AS (SELECT *, lead(t) OVER (PARTITION BY path ORDER BY t, comes) AS e FROM m),
i AS (SELECT path, t AS start, e, before, path || '@' || t AS id FROM s WHERE comes)"""


@query(f"""WITH RECURSIVE {FILES_SQL}, r AS (SELECT id, id AS file FROM i WHERE before IS NULL UNION ALL SELECT i.id, r.file FROM r JOIN i p ON p.id = r.id JOIN i ON i.before = p.path AND i.start = p.e),
h AS (SELECT i.path, i.start, i.e, r.file FROM i LEFT JOIN r USING (id)), b AS (SELECT event_id, substr('abc', event_id % 3 + 1, 1) || '/' || user_id AS path, CASE WHEN event_id % 4 = 0 THEN 'u' || event_id % 3 END AS upload, CASE WHEN event_id % 7 = 0 THEN 1 ELSE user_id END AS size FROM events WHERE event_id % 5 >= 3),
c AS (SELECT i.id AS file, k, i.id || '#' || k AS receipt, 'u' || k AS upload, split_part(path, '/', 2)::BIGINT AS size, start % 4 <> 0 AS verified FROM i, (SELECT unnest([0, 1]) AS k) WHERE before IS NULL AND (k = 0 OR start % 3 = 0)),
p AS (SELECT b.*, h.file FROM b LEFT JOIN h ON h.path = b.path AND h.start <= event_id AND (h.e IS NULL OR event_id < h.e)),
n AS (SELECT p.event_id, count(*) AS n, min(c.receipt) AS receipt, bool_and(verified) AS verified FROM p JOIN c ON c.file = p.file AND CASE WHEN p.upload IS NOT NULL THEN p.upload = c.upload ELSE p.size = c.size END GROUP BY 1),
x AS (SELECT p.event_id, p.file, n.receipt, CASE WHEN p.file IS NULL THEN 'no_file' WHEN n IS NULL THEN 'missing' WHEN n > 1 THEN 'ambiguous' WHEN NOT verified THEN 'unverified' ELSE 'bound' END AS outcome FROM p LEFT JOIN n USING (event_id))
SELECT event_id, file, CASE WHEN outcome = 'bound' THEN receipt END AS receipt, outcome FROM x""")
def attachment_binding(spark, sf_dir):
    """Attachments by path as of their time, over renames and paths used again, to exactly one verified receipt of the file."""
    events, e = table(spark, sf_dir, "events").select("event_id", "user_id"), F.col("event_id")
    named = lambda letter: F.concat(letter if not isinstance(letter, str) else F.lit(letter), F.lit("/"), F.col("user_id").cast("string"))
    created = events.where(e % 5 == 0).select(named("a").alias("path"), e.alias("at"))
    renamed = events.where((e % 5).isin(1, 2)).select(named(F.when(e % 5 == 1, "b").otherwise("c")).alias("path"), named(F.when(e % 5 == 1, "a").otherwise("b")).alias("source"), e.alias("at"))
    history = trees.path_history(created, renamed)
    letter = F.get(F.array(F.lit("a"), F.lit("b"), F.lit("c")), (e % 3).cast("int"))
    upload = F.when(e % 4 == 0, F.concat(F.lit("u"), (e % 3).cast("string")))
    blocks = events.where(e % 5 >= 3).select("event_id", named(letter).alias("path"), e.alias("at"), upload.alias("upload_id"), F.lit("same").alias("sha256"), F.when(e % 7 == 0, 1).otherwise(F.col("user_id")).alias("size"))
    k = F.col("k").cast("string")
    files = created.select(F.concat("path", F.lit("@"), F.col("at").cast("string")).alias("file"), F.split("path", "/")[1].cast("long").alias("size"), "at", F.explode(F.array(F.lit(0), F.lit(1))).alias("k"))
    receipts = files.where("k = 0 or at % 3 = 0").select(F.concat("file", F.lit("#"), k).alias("receipt"), "file", F.concat(F.lit("u"), k).alias("upload_id"), F.lit("same").alias("sha256"), "size", (F.col("at") % 4 != 0).alias("verified"))
    return trees.bound_attachments(blocks, history, receipts, "event_id")


@query("""WITH k AS (SELECT user_id AS chain, event_id, row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1 AS k, count(*) OVER (PARTITION BY user_id) AS n FROM events),
e AS (SELECT chain, k // 5 AS place, (n - 1) // 5 AS last, n, CASE WHEN chain % 11 = 6 AND k = 5 THEN lag(event_id, 5) OVER (PARTITION BY chain ORDER BY k) ELSE event_id END AS id FROM k),
p AS (SELECT chain, place, any_value(last) AS last, any_value(n) AS n, list(id) AS ids, count(*) AS c FROM e GROUP BY ALL),
g AS (SELECT chain, place, CASE WHEN chain % 11 = 2 AND place = 1 THEN 'zz' WHEN place > 0 THEN 'c' || place END AS cursor, CASE WHEN chain % 11 = 3 AND place = 1 THEN 'c1' WHEN place < last THEN 'c' || place + 1 WHEN chain % 11 = 4 THEN 'more' END AS next,
  CASE WHEN NOT (chain % 11 = 1 AND place = 1) THEN place < last END AS has_more, n + (chain % 11 = 7)::INT AS total, c, ids FROM p WHERE NOT (chain % 11 = 5 AND place = last)),
f AS (SELECT *, lag(next) OVER w AS given, lag(has_more) OVER w AS went_on, lag(place) OVER w AS before FROM g WINDOW w AS (PARTITION BY chain ORDER BY place)),
t AS (SELECT chain FROM (SELECT chain, unnest(ids) AS id FROM g) GROUP BY chain, id HAVING count(*) > 1), a AS (SELECT chain FROM g WHERE next IS NOT NULL GROUP BY chain, next HAVING count(*) > 1),
s AS (SELECT chain, count(*) AS n_pages, sum(c)::BIGINT AS n_rows, CASE WHEN bool_or(has_more IS NULL) THEN 'shape' WHEN bool_or(CASE WHEN place = 0 THEN cursor IS NOT NULL ELSE before IS NULL OR cursor IS DISTINCT FROM given END) THEN 'cursor'
  WHEN chain IN (SELECT chain FROM a) THEN 'repeated_cursor' WHEN bool_or(has_more AND next IS NULL) THEN 'empty_page' WHEN bool_or(NOT has_more AND next IS NOT NULL) THEN 'end' WHEN bool_or(NOT went_on) THEN 'after_last' WHEN arg_max(has_more, place) THEN 'missing_last'
  WHEN chain IN (SELECT chain FROM t) THEN 'repeated_id' WHEN max(total) <> sum(c) THEN 'total' WHEN sum(c * 40) > 2800 THEN 'bytes' ELSE 'complete' END AS outcome FROM f GROUP BY chain)
SELECT * FROM s""")
def paged_listing(spark, sf_dir):
    """Listings of each user's events, five to a page, some of them broken: what each chain of pages is worth."""
    c, last, p = F.col("chain") % 11, F.col("last"), F.col("place")
    rows = ranking.numbered(table(spark, sf_dir, "events").select(F.col("user_id").alias("chain"), "event_id"), "chain", "event_id", "k")
    sizes = rows.groupBy("chain").agg(F.count("*").alias("n"), F.min("event_id").alias("first"))
    listed = rows.join(sizes, "chain").withColumn("place", F.floor((F.col("k") - 1) / 5).cast("int")).withColumn("last", F.floor((F.col("n") - 1) / 5).cast("int"))
    ids = F.when((c == 6) & (F.col("k") == 6), F.col("first")).otherwise(F.col("event_id"))
    # five rows to a page
    pages = listed.groupBy("chain", "place", "last", "n").agg(F.collect_list(F.struct(ids.alias("id"))).alias("rows")).where(~((c == 5) & (p == last)))
    at = lambda k: F.concat(F.lit("c"), k.cast("string"))
    made = pages.select(
        "chain", "place", F.when((c == 2) & (p == 1), "zz").when(p > 0, at(p)).alias("cursor"), F.when((c == 3) & (p == 1), "c1").when(p < last, at(p + 1)).when(c == 4, "more").alias("next"),
        F.when(~((c == 1) & (p == 1)), p < last).alias("has_more"), (F.col("n") + (c == 7).cast("int")).alias("total"), (F.size("rows") * 40).alias("bytes"), "rows",
    )
    return paged.chain_outcomes(made, most_bytes=2800)


@query("""WITH d AS (SELECT doc_id AS id, md5(text) AS h FROM documents), s AS (SELECT id, 'v' || CASE WHEN id % 5 = 0 THEN 2 ELSE 1 END AS version, h AS summary FROM d WHERE id % 13 <> 4),
t AS (SELECT id, id % 40 AS created, h AS rendered, CASE WHEN id % 29 = 1 THEN 'n/same' || id // 100 ELSE 'n/' || id END AS path FROM d WHERE id % 17 <> 3),
r AS (SELECT id, 'v1' AS version, h AS summary, CASE WHEN id % 50 = 0 THEN -1 ELSE id % 40 END AS created, 'o/' || id AS path, CASE WHEN id % 10 = 0 THEN 'older' ELSE h END AS mirror FROM d WHERE id % 2 = 0),
c AS (SELECT path, id, CASE WHEN id % 22 = 0 THEN 'edited' ELSE mirror END AS content FROM r WHERE id % 26 <> 8 UNION ALL SELECT 'copy/' || id, id, 'x' FROM d WHERE id % 31 = 7 UNION ALL SELECT 'n/' || id, NULL, 'y' FROM d WHERE id % 37 = 5),
p AS (SELECT id, 'p/' || id AS path, CASE WHEN id % 3 = 0 THEN h ELSE 'z' END AS rendered FROM d WHERE id % 7 = 1), v AS (SELECT id FROM d WHERE id % 41 = 9),
a AS (SELECT id FROM s UNION SELECT id FROM r), f AS (SELECT id, count(*) > 1 AS many FROM c WHERE id IS NOT NULL GROUP BY id),
j AS (SELECT a.id, s.id IS NOT NULL AS listed, s.version, s.summary, t.id IS NOT NULL AS detailed, t.created, t.rendered, r.id IS NOT NULL AS old, r.version AS ov, r.summary AS os, r.created AS oc, r.mirror, f.id IS NOT NULL AS present, coalesce(many, false) AS many,
  v.id IS NOT NULL AS kept_back, coalesce(p.rendered = t.rendered, false) AS exact, CASE WHEN r.id IS NOT NULL THEN r.path WHEN coalesce(p.rendered = t.rendered, false) THEN p.path ELSE t.path END AS path
  FROM a LEFT JOIN s ON s.id = a.id LEFT JOIN t ON t.id = a.id LEFT JOIN r ON r.id = a.id LEFT JOIN f ON f.id = a.id LEFT JOIN p ON p.id = a.id LEFT JOIN v ON v.id = a.id),
k AS (SELECT j.*, (SELECT min(content) FROM c WHERE c.path = j.path) AS content, min(CASE WHEN NOT old AND detailed AND listed AND NOT present AND NOT kept_back THEN id END) OVER (PARTITION BY path) AS first_id FROM j),
o AS (SELECT *, CASE WHEN many OR kept_back THEN 'identity_reserved' WHEN NOT listed THEN 'source_missing' WHEN old AND content IS DISTINCT FROM mirror THEN 'local_note_edited' WHEN old AND version = ov AND summary = os THEN '=unchanged' WHEN NOT old AND present THEN 'identity_reserved'
  WHEN NOT detailed THEN '=detail_required' WHEN old AND created <> oc THEN 'source_created_changed' WHEN old AND rendered = content THEN '=state_only' WHEN old THEN '=updated' WHEN content IS NOT NULL OR first_id <> id THEN 'destination_collision' WHEN exact THEN '=preview_imported' ELSE '=created' END AS x FROM k)
SELECT id, path, CASE WHEN x LIKE '=%' THEN x[2:] ELSE 'conflicted' END AS outcome, CASE WHEN x NOT LIKE '=%' THEN x END AS reason FROM o""")
def record_proposals(spark, sf_dir):
    """Documents as records of a source, half of them registered: what is proposed for each."""
    i, text = F.col("id"), lambda *c: F.concat(*(F.lit(x) if isinstance(x, str) else x.cast("string") for x in c))
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), F.md5("text").alias("h"))
    summaries = docs.where(i % 13 != 4).select("id", F.when(i % 5 == 0, "v2").otherwise("v1").alias("version"), F.col("h").alias("summary"))
    details = docs.where(i % 17 != 3).select("id", (i % 40).alias("created"), F.col("h").alias("rendered"), F.when(i % 29 == 1, text("n/same", F.floor(i / 100))).otherwise(text("n/", i)).alias("path"))
    registry = docs.where(i % 2 == 0).select("id", F.lit("v1").alias("version"), F.col("h").alias("summary"), F.when(i % 50 == 0, -1).otherwise(i % 40).alias("created"), text("o/", i).alias("path"), F.when(i % 10 == 0, "older").otherwise(F.col("h")).alias("mirror"))
    there = registry.where(i % 26 != 8).select("path", "id", F.when(i % 22 == 0, "edited").otherwise(F.col("mirror")).alias("content"))
    copies = docs.where(i % 31 == 7).select(text("copy/", i).alias("path"), "id", F.lit("x").alias("content"))
    others = docs.where(i % 37 == 5).select(text("n/", i).alias("path"), F.lit(None).cast("long").alias("id"), F.lit("y").alias("content"))
    previews = docs.where(i % 7 == 1).select("id", text("p/", i).alias("path"), F.when(i % 3 == 0, F.col("h")).otherwise("z").alias("rendered"))
    return proposals.propose(summaries, details, registry, there.unionByName(copies).unionByName(others), previews, docs.where(i % 41 == 9).select("id"))


@query("""WITH l AS (SELECT l_orderkey AS k, list(l_partkey ORDER BY l_linenumber, l_partkey) AS p FROM lineitem GROUP BY 1)
SELECT k, CASE WHEN len(p) <= 2 THEN 'whole' WHEN k % 9 = 2 THEN 'missing' WHEN k % 9 = 4 THEN 'missing_last' WHEN k % 9 = 6 THEN 'prefix_changed' ELSE 'hydrated' END AS outcome,
array_to_string(CASE WHEN len(p) <= 2 OR k % 9 NOT IN (2, 4, 6) THEN p WHEN k % 9 = 6 THEN [-1, p[2]] ELSE p[1:2] END, ',') AS items FROM l""")
def hydrated_lists(spark, sf_dir):
    """Parts of orders shown two at most, completed from pages of two, some of which are missing or were changed."""
    k = F.col("k")
    parts = F.transform(F.sort_array(F.collect_list(F.struct("l_linenumber", "l_partkey"))), lambda x: x["l_partkey"])
    # an order has at most seven lines
    orders = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("k")).agg(parts.alias("p")).withColumn("prop", F.lit("parts")).withColumn("n", F.size("p"))
    shown = F.when((k % 9 == 6) & (F.col("n") > 2), F.array(F.lit(-1).cast("long"), F.get("p", F.lit(1)))).otherwise(F.slice("p", 1, 2))
    records = orders.select("k", "prop", shown.alias("items"), (F.col("n") > 2).alias("has_more"))
    last = F.floor((F.col("n") - 1) / 2).cast("int")
    pages = orders.where(k % 9 != 2).select("k", "prop", "p", last.alias("last"), F.explode(F.sequence(F.lit(0), last)).alias("place")).where(~((k % 9 == 4) & (F.col("place") == F.col("last"))))
    at = lambda v: F.concat(F.lit("c"), v.cast("string"))
    made = pages.select(
        "k", "prop", "place", F.when(F.col("place") > 0, at(F.col("place"))).alias("cursor"), F.when(F.col("place") < F.col("last"), at(F.col("place") + 1)).alias("next"), (F.col("place") < F.col("last")).alias("has_more"),
        F.transform(F.slice("p", F.col("place") * 2 + 1, F.lit(2)), lambda x: F.struct(x.alias("id"))).alias("rows"),
    )
    done = proposals.hydrate(records, made, "k", "prop")
    return done.select("k", "outcome", F.array_join(F.transform("items", lambda x: x.cast("string")), ",").alias("items"))
