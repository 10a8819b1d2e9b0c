"""Queries over typed and nested records: properties, versions, evidence, selection of fields."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from siltworks.functions import dates, records
from siltworks.operators import merging as merge_ops
from siltworks.plans.registry import query, table

#: One property for each document, its kind by doc_id.
KINDS = ("title", "rich_text", "number", "checkbox", "select", "status", "multi_select", "date", "url", "email", "phone_number", "people", "relation", "files", "formula", "rollup")


@query("""WITH d AS (SELECT doc_id, doc_id % 16 AS k, lang, source, CAST(doc_id AS VARCHAR) AS s FROM documents)
SELECT doc_id, CASE k WHEN 0 THEN lang || source WHEN 1 THEN lang || source WHEN 2 THEN s WHEN 3 THEN 'true' WHEN 4 THEN lang WHEN 5 THEN lang WHEN 6 THEN '["' || lang || '","' || source || '"]'
WHEN 7 THEN '2024-01-01 → 2024-01-02' WHEN 8 THEN 'https://a.example/' || s WHEN 9 THEN s || '@example.com' WHEN 10 THEN '+' || s WHEN 11 THEN '["' || lang || '","u' || s || '"]'
WHEN 12 THEN '{"count":2,"ids":["' || lang || '","' || source || '"]}' WHEN 13 THEN '["' || lang || '","external","file"]' WHEN 14 THEN source WHEN 15 THEN s END AS value FROM d""")
def typed_properties(spark, sf_dir):
    k, s = F.col("doc_id") % 16, F.col("doc_id").cast("string")
    text = lambda *parts: F.concat(*(F.lit(p) if isinstance(p, str) else p for p in parts))
    lang, source = F.col("lang"), F.col("source")
    runs = text('[{"plain_text":"', lang, '"},{"plain_text":"', source, '"}]')
    data = {
        "title": runs, "rich_text": runs, "number": s, "checkbox": F.lit("true"), "select": text('{"name":"', lang, '"}'), "status": text('{"name":"', lang, '"}'),
        "multi_select": text('[{"name":"', lang, '"},{"name":""},{"name":"', source, '"}]'), "date": F.lit('{"start":"2024-01-01","end":"2024-01-02"}'), "url": text('"https://a.example/', s, '"'),
        "email": text('"', s, '@example.com"'), "phone_number": text('"+', s, '"'), "people": text('[{"name":"', lang, '","id":"x"},{"id":"u', s, '"}]'),
        "relation": text('[{"id":"', lang, '"},{},{"id":"', source, '"}]'), "files": text('[{"name":"', lang, '"},{"type":"external"},{}]'),
        "formula": text('{"type":"string","string":"', source, '"}'), "rollup": text('{"type":"number","number":', s, "}"),
    }
    made = F.coalesce(*(F.when(k == i, text('{"id":"p","type":"', name, '","', name, '":', data[name], "}")) for i, name in enumerate(KINDS)))
    return table(spark, sf_dir, "documents").select("doc_id", records.plain_property(made).alias("value"))


NESTED_SQL = """SELECT doc_id, lang, source, n_chars, text FROM documents"""


def nested(spark, sf_dir):
    part = F.struct(F.col("source").alias("type"), F.lit("x").alias("at"), F.col("lang").alias("name"))
    meta = F.struct(F.col("n_chars").alias("size"), F.lit("now").alias("generated_at"), F.array(part, part).alias("parts"), F.lit(None).cast("string").alias("empty"))
    return table(spark, sf_dir, "documents").select("doc_id", F.struct(F.col("source"), meta.alias("meta"), F.lit("then").alias("generated_at")).alias("record"))


@query(f"""SELECT doc_id, sha256('{{"meta":{{"empty":null,"parts":[' || p || ',' || p || '],"size":' || n_chars || '}},"source":"' || source || '"}}') AS digest
FROM (SELECT *, '{{"name":"' || lang || '","type":"' || source || '"}}' AS p FROM ({NESTED_SQL}))""")
def canonical_nested(spark, sf_dir):
    """Digests of nested records that no order of fields and no volatile field changes."""
    rows = nested(spark, sf_dir)
    text = records.canonical_text(F.col("record"), rows.schema["record"].dataType, ("generated_at", "at"))
    return rows.select("doc_id", F.sha2(text, 256).alias("digest"))


@query(f"""SELECT doc_id, array_to_string([source, 'now', source, 'x', lang, source, 'x', lang, 'then'], '|') AS strings FROM ({NESTED_SQL})""")
def nested_strings(spark, sf_dir):
    rows = nested(spark, sf_dir)
    found = records.strings_of(F.col("record"), rows.schema["record"].dataType)
    return rows.select("doc_id", F.array_join(found, "|").alias("strings"))


ASSET_SQL = """SELECT page_id, CASE page_id % 6 WHEN 0 THEN 'https://assets.example.com/f' || page_id || '?Expires=1&OSSAccessKeyId=k' || page_id || '&Signature=s&v=2' WHEN 1 THEN 'https://assets.example.com/f' || page_id || '?Expires=1&Signature=s'
WHEN 2 THEN 'https://other.example.com/f' || page_id || '?Expires=1&OSSAccessKeyId=k&Signature=s' WHEN 3 THEN 'https://assets.example.com/f' || page_id || '?v=1' WHEN 4 THEN 'https://assets.example.com/f' || page_id || '?OSSAccessKeyId=k&v=3&Expires=1&Signature=s#top'
ELSE 'https://assets.example.com/f' || page_id || '?Expires=1&OSSAccessKeyId=k&Signature=s' END AS url FROM pages"""


@query(f"""SELECT page_id, sha256(CASE page_id % 6 WHEN 0 THEN 'https://assets.example.com/f' || page_id || '?v=2' WHEN 4 THEN 'https://assets.example.com/f' || page_id || '?v=3#top' WHEN 5 THEN 'https://assets.example.com/f' || page_id ELSE url END) AS version
FROM ({ASSET_SQL})""")
def signed_url_version(spark, sf_dir):
    """Versions of asset links: only the whole signing triplet, only on its host, does not count."""
    k, place = F.col("page_id") % 6, F.concat(F.lit("/f"), F.col("page_id").cast("string"))
    link = lambda host, *rest: F.concat(F.lit(f"https://{host}.example.com"), place, *(F.lit(r) if isinstance(r, str) else r for r in rest))
    url = (
        F.when(k == 0, link("assets", "?Expires=1&OSSAccessKeyId=k", F.col("page_id").cast("string"), "&Signature=s&v=2")).when(k == 1, link("assets", "?Expires=1&Signature=s"))
        .when(k == 2, link("other", "?Expires=1&OSSAccessKeyId=k&Signature=s")).when(k == 3, link("assets", "?v=1")).when(k == 4, link("assets", "?OSSAccessKeyId=k&v=3&Expires=1&Signature=s#top"))
        .otherwise(link("assets", "?Expires=1&OSSAccessKeyId=k&Signature=s"))
    )
    stable = records.stable_asset_url(url, "assets.example.com", ("Expires", "OSSAccessKeyId", "Signature"))
    return table(spark, sf_dir, "pages").select("page_id", F.sha2(stable, 256).alias("version"))


@query("""WITH e AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CASE WHEN l_linenumber % 3 = 0 THEN NULL ELSE CAST(l_shipdate AS DATE) END AS ship, CAST(o_orderdate AS DATE) AS ordered, CAST(o_orderdate AS DATE) + CAST(l_linenumber * 30 AS INTEGER) AS later
FROM lineitem JOIN orders ON l_orderkey = o_orderkey), c AS (SELECT *, CASE WHEN ship BETWEEN DATE '1995-01-01' AND DATE '1996-12-31' THEN 'ship' WHEN ordered BETWEEN DATE '1995-01-01' AND DATE '1996-12-31' THEN 'ordered'
WHEN later BETWEEN DATE '1995-01-01' AND DATE '1996-12-31' THEN 'later' END AS field FROM e)
SELECT field, count(*) AS n, CAST(min(CASE field WHEN 'ship' THEN ship WHEN 'ordered' THEN ordered ELSE later END) AS VARCHAR) AS first_day FROM c WHERE field IS NOT NULL GROUP BY field""")
def evidence_window(spark, sf_dir):
    """Rows by the first of their evidence dates that lies in the window."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", F.when(F.col("l_linenumber") % 3 != 0, F.to_date("l_shipdate")).alias("ship"))
    rows = lines.join(table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"), F.to_date("o_orderdate").alias("ordered")), "l_orderkey")
    found = records.first_in_window([("ship", F.col("ship")), ("ordered", F.col("ordered")), ("later", F.date_add("ordered", F.col("l_linenumber") * 30))], "1995-01-01", "1996-12-31")
    return rows.select(found.alias("e")).where("e is not null").groupBy("e.field").agg(F.count("*").alias("n"), F.min("e.day").cast("string").alias("first_day"))


@query(r"""WITH t AS (SELECT event_id, CASE WHEN event_id % 7 = 0 THEN event_type ELSE event_type || ' ' || user_id || ' on ' || strftime(ts, '%Y-%m-') || lpad((event_id % 36)::VARCHAR, 2, '0') || ', seen ' || strftime(ts, '%Y-%m-%dT%H:%M') END AS t FROM events)
SELECT event_id, try_cast(nullif(regexp_extract(t, '20\d{2}-\d{2}-\d{2}'), '') AS DATE)::VARCHAR AS day FROM t""")
def first_date_found(spark, sf_dir):
    """The first date in texts made from events; one that no calendar has gives none."""
    e = F.col("event_id")
    day = F.concat(F.date_format("ts", "yyyy-MM-"), F.lpad((e % 36).cast("string"), 2, "0"))
    stamp = F.when(e % 7 == 0, F.col("event_type")).otherwise(F.concat_ws("", "event_type", F.lit(" "), F.col("user_id").cast("string"), F.lit(" on "), day, F.lit(", seen "), F.date_format("ts", "yyyy-MM-dd'T'HH:mm")))
    return table(spark, sf_dir, "events").select("event_id", dates.first_date(stamp).cast("string").alias("day"))


@query("""WITH d AS (SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN '' ELSE lang END AS lang, source, CASE WHEN doc_id % 2 = 0 THEN NULL ELSE 'x' END AS extra FROM documents)
SELECT doc_id, array_to_string(list_filter([CASE WHEN extra IS NOT NULL THEN 'z_extra' END, CASE WHEN lang <> '' THEN 'lang' END, CASE WHEN extra IS NOT NULL THEN 'a_note' END, 'doc', 'source'], lambda x: x IS NOT NULL)[1:4], ',') AS fields FROM d""")
def preferred_fields(spark, sf_dir):
    extra = F.when(F.col("doc_id") % 2 != 0, "x")
    made = F.create_map(F.lit("source"), F.col("source"), F.lit("lang"), F.when(F.col("doc_id") % 3 == 0, "").otherwise(F.col("lang")), F.lit("a_note"), extra, F.lit("doc"), F.col("doc_id").cast("string"), F.lit("z_extra"), extra)
    return table(spark, sf_dir, "documents").select("doc_id", F.array_join(records.preferred(made, ("z_extra", "lang"), 4), ",").alias("fields"))


@query("""SELECT event_id FROM events WHERE event_id % 10 = 0 OR ts >= TIMESTAMP '2024-01-10'""")
def open_time_window(spark, sf_dir):
    """Rows since a day; rows without a stamp pass."""
    rows = table(spark, sf_dir, "events").select("event_id", F.when(F.col("event_id") % 10 != 0, F.col("ts")).alias("ts"))
    return rows.where(F.col("ts").isNull() | (F.col("ts") >= F.lit("2024-01-10").cast("timestamp_ntz"))).select("event_id")


@query("""SELECT doc_id, doc_id % 5 = 1 OR lang = 'de' OR contains(text, '![') AS needs_assets, CASE WHEN doc_id % 7 = 0 OR source = 'src3' THEN 'untrusted' ELSE 'trusted' END AS trigger FROM documents""")
def asset_and_trigger_checks(spark, sf_dir):
    """Which notes need their binaries, and which triggers are trusted: right actor and not from a fork."""
    d = F.col("doc_id")
    kinds = F.when(d % 5 == 1, F.array(F.lit("link"), F.lit("image"))).otherwise(F.array(F.lit("link")))
    note_type = F.when(F.col("lang") == "de", "recorder").otherwise("plain_text")
    trusted = (d % 7 != 0) & (F.col("source") != "src3")
    return table(spark, sf_dir, "documents").select("doc_id", records.needs_assets(kinds, note_type, F.col("text")).alias("needs_assets"), F.when(trusted, "trusted").otherwise("untrusted").alias("trigger"))


@query("""WITH m AS (SELECT doc_id, lang, source, CASE WHEN n_chars % 5 <> 0 THEN n_chars::VARCHAR ELSE '' END AS size, CASE WHEN doc_id % 3 = 0 THEN '' ELSE lang END AS lang2, CASE WHEN n_chars % 4 <> 0 THEN source END AS source2 FROM documents),
l AS (SELECT doc_id, list_filter([CASE WHEN coalesce(lang, '') <> '' AND coalesce(lang2, '') = '' THEN 'lang' END, CASE WHEN coalesce(source, '') <> '' AND coalesce(source2, '') = '' THEN 'source' END, CASE WHEN coalesce(size, '') <> '' THEN 'size' END], lambda x: x IS NOT NULL) AS l FROM m)
SELECT doc_id, array_to_string(list_sort(l), ',') AS missing FROM l WHERE len(l) > 0""")
def lost_metadata(spark, sf_dir):
    """Fields of documents that had a value and lost it: size is gone, empty before values may stay empty."""
    d, n = F.col("doc_id"), F.col("n_chars")
    before = F.create_map(F.lit("lang"), F.col("lang"), F.lit("source"), F.col("source"), F.lit("size"), F.when(n % 5 != 0, n.cast("string")).otherwise(""))
    after = F.create_map(F.lit("lang"), F.when(d % 3 == 0, "").otherwise(F.col("lang")), F.lit("source"), F.when(n % 4 != 0, F.col("source")))
    lost = records.missing_fields(before, after)
    return table(spark, sf_dir, "documents").select("doc_id", lost.alias("lost")).where("size(lost) > 0").select("doc_id", F.array_join("lost", ",").alias("missing"))


@query("""SELECT doc_id, array_to_string(list_filter([lang, source, CASE WHEN lang <> 'en' THEN 'en' END], lambda x: x IS NOT NULL), ',') AS tags FROM documents""")
def tag_list(spark, sf_dir):
    made = F.concat(F.lit('[" '), F.col("lang"), F.lit(' ",{"name":"'), F.col("source"), F.lit('","type":"t"},"",{"type":"x"},{"name":"en"},"'), F.col("lang"), F.lit('"]'))
    return table(spark, sf_dir, "documents").select("doc_id", F.array_join(records.tag_names(made), ",").alias("tags"))


@query("""WITH RECURSIVE t AS (SELECT conv_id AS k, strlen(coalesce(text, '')) AS y, 1 + turn % 3 AS w, row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, md5(text)) AS i FROM conversations),
b AS (SELECT k, i, 1 AS n, w AS tw, y AS ty, 0 AS batch FROM t WHERE i = 1 UNION ALL
SELECT t.k, t.i, CASE WHEN f THEN 1 ELSE n + 1 END, CASE WHEN f THEN x.w ELSE tw + x.w END, CASE WHEN f THEN x.y ELSE ty + x.y END, CASE WHEN f THEN batch + 1 ELSE batch END
FROM (SELECT b.*, t.w, t.y, b.n >= 4 OR b.tw + t.w > 6 OR b.ty + t.y > 1500 AS f FROM b JOIN t ON t.k = b.k AND t.i = b.i + 1) x JOIN t ON t.k = x.k AND t.i = x.i + 1)
SELECT k AS conv_id, array_to_string(list(batch ORDER BY i), ',') AS assigned FROM b GROUP BY k""")
def payload_batches(spark, sf_dir):
    """Turns packed under three limits at once: 4 items, a weight of 6 and 1,500 bytes in a batch."""
    item = F.struct("turn", "role", F.md5("text").alias("h"), (F.col("turn") % 3 + 1).alias("w"), F.octet_length(F.coalesce("text", F.lit(""))).cast("long").alias("y"))
    packed = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.sort_array(F.collect_list(item)).alias("t"))
    batches = merge_ops.batches_within(F.transform("t", lambda x: F.array(F.lit(1).cast("long"), x["w"], x["y"])), (4, 6, 1500))
    return packed.select("conv_id", F.array_join(F.transform(batches, lambda x: x.cast("string")), ",").alias("assigned"))


@query("""WITH n AS (SELECT l_orderkey, l_partkey, min(l_linenumber) AS line FROM lineitem GROUP BY ALL) SELECT l_orderkey, string_agg(p_name, '|' ORDER BY line, l_partkey) AS names, first(p_name ORDER BY line, l_partkey) AS first_name FROM n JOIN part ON p_partkey = l_partkey GROUP BY l_orderkey""")
def relation_titles(spark, sf_dir):
    """Ids of a relation with their titles, in the relation's order."""
    ids = table(spark, sf_dir, "lineitem").groupBy("l_orderkey", "l_partkey").agg(F.min("l_linenumber").alias("line"))
    titled = ids.join(table(spark, sf_dir, "part").select(F.col("p_partkey").alias("l_partkey"), "p_name"), "l_partkey")
    ordered = F.transform(F.sort_array(F.collect_list(F.struct("line", "l_partkey", "p_name"))), lambda x: x["p_name"])
    return titled.groupBy("l_orderkey").agg(ordered.alias("n")).select("l_orderkey", F.array_join("n", "|").alias("names"), F.get("n", F.lit(0)).alias("first_name"))


@query("""WITH a AS (SELECT l_orderkey AS k, CASE WHEN l_linenumber % 3 = 0 THEN 'p' || l_linenumber ELSE 'i' || l_partkey END AS slot, max(l_suppkey) AS v FROM lineitem GROUP BY ALL),
b AS (SELECT l_orderkey AS k, CASE WHEN l_linenumber % 3 = 0 THEN 'p' || l_linenumber ELSE 'i' || (l_partkey + CASE WHEN l_orderkey % 10 = 0 THEN 1 ELSE 0 END) END AS slot, max(l_suppkey + CASE WHEN l_linenumber % 5 = 0 THEN 1 ELSE 0 END) AS v FROM lineitem WHERE l_linenumber <> 2 GROUP BY ALL)
SELECT coalesce(a.k, b.k) AS l_orderkey, CAST(count(*) FILTER (WHERE a.k IS NULL) AS BIGINT) AS added, CAST(count(*) FILTER (WHERE b.k IS NULL) AS BIGINT) AS removed, CAST(count(*) FILTER (WHERE a.v <> b.v) AS BIGINT) AS changed, CAST(count(*) FILTER (WHERE a.v = b.v) AS BIGINT) AS kept
FROM a FULL JOIN b ON a.k = b.k AND a.slot = b.slot GROUP BY 1""")
def attachment_changes(spark, sf_dir):
    """Two attachment lists paired by identity where an entry has one, else by position."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    slot = lambda part: F.when(F.col("l_linenumber") % 3 == 0, F.concat(F.lit("p"), F.col("l_linenumber").cast("string"))).otherwise(F.concat(F.lit("i"), part.cast("string"))).alias("slot")
    before = lines.groupBy("l_orderkey", slot(F.col("l_partkey"))).agg(F.max("l_suppkey").alias("a"))
    moved = F.col("l_partkey") + F.when(F.col("l_orderkey") % 10 == 0, 1).otherwise(0)
    after = lines.where("l_linenumber <> 2").groupBy("l_orderkey", slot(moved)).agg(F.max(F.col("l_suppkey") + F.when(F.col("l_linenumber") % 5 == 0, 1).otherwise(0)).alias("b"))
    both = before.join(after, ["l_orderkey", "slot"], "full")
    a, b = F.col("a"), F.col("b")
    return both.groupBy("l_orderkey").agg(F.count_if(a.isNull()).alias("added"), F.count_if(b.isNull()).alias("removed"), F.count_if(a != b).alias("changed"), F.count_if(a == b).alias("kept"))


@query("""WITH p AS (SELECT l_orderkey AS k, l_partkey AS id, min(l_linenumber) AS i FROM lineitem GROUP BY ALL), l AS (SELECT k, list(id ORDER BY i, id) AS have FROM p GROUP BY k),
u AS (SELECT k, have, list_concat(have, list_filter([k % 200, have[1], -1], lambda x: NOT list_contains(have, x))) AS r FROM l) SELECT k AS l_orderkey, array_to_string(list_filter(r, lambda x, i: list_position(r, x) = i), ',') AS ids FROM u""")
def relation_union(spark, sf_dir):
    """New ids added to a relation: what it has stays in order, each id once."""
    first = table(spark, sf_dir, "lineitem").groupBy("l_orderkey", "l_partkey").agg(F.min("l_linenumber").alias("i"))
    have = first.groupBy("l_orderkey").agg(F.transform(F.sort_array(F.collect_list(F.struct("i", "l_partkey"))), lambda x: x["l_partkey"]).alias("have"))
    more = F.array(F.col("l_orderkey") % 200, F.get("have", F.lit(0)), F.lit(-1).cast("long"))
    return have.select("l_orderkey", F.array_join(F.transform(F.array_union("have", more), lambda x: x.cast("string")), ",").alias("ids"))


@query("""SELECT doc_id, CAST(CASE WHEN contains(lower(text), 'rights') THEN 3 ELSE 0 END + CASE WHEN contains(lower(text), 'license') THEN 2 ELSE 0 END + CASE WHEN contains(lower(text), 'the ') THEN 1 ELSE 0 END + CASE WHEN length(text) > 2000 THEN 1 ELSE 0 END AS BIGINT) AS score FROM documents""")
def keyword_score(spark, sf_dir):
    has = lambda word, n: F.when(F.lower("text").contains(word), n).otherwise(0)
    score = has("rights", 3) + has("license", 2) + has("the ", 1) + F.when(F.length("text") > 2000, 1).otherwise(0)
    return table(spark, sf_dir, "documents").select("doc_id", score.cast("long").alias("score"))


@query("""SELECT conv_id, turn, role, segment, CAST(row_number() OVER (PARTITION BY conv_id, segment ORDER BY turn, role, text) AS BIGINT) AS number FROM (
SELECT *, CAST(sum(CASE WHEN before = role THEN 0 ELSE 1 END) OVER (PARTITION BY conv_id ORDER BY turn, role, text ROWS UNBOUNDED PRECEDING) AS BIGINT) AS segment
FROM (SELECT *, lag(role) OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS before FROM conversations))""")
def list_numbering(spark, sf_dir):
    """Numbers of list items, from 1 where a segment is known to start."""
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    starts = F.when(F.lag("role").over(order) == F.col("role"), 0).otherwise(1)
    rows = table(spark, sf_dir, "conversations").withColumn("starts", starts).withColumn("segment", F.sum("starts").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    number = F.row_number().over(Window.partitionBy("conv_id", "segment").orderBy("turn", "role", "text")).cast("long")
    return rows.select("conv_id", "turn", "role", "segment", number.alias("number"))
