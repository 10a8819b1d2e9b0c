"""Text, date and JSON queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from siltworks.functions import dates, hashing, html_markdown, markdown, numbers, text
from siltworks.plans.registry import query, table

#: Titles with dates, tags and noise, derived from documents by fixed rules.
TITLE_SQL = """SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN '2024-01-15 ' WHEN doc_id % 3 = 1 THEN '20240115_1030 ' ELSE '' END || string_split(text, chr(10))[1] || CASE WHEN doc_id % 4 = 0 THEN ' #tag' ELSE '' END AS title FROM documents"""


def titles(spark, sf_dir):
    line = F.get(F.split("text", "\n"), F.lit(0))
    prefix = F.when(F.col("doc_id") % 3 == 0, "2024-01-15 ").when(F.col("doc_id") % 3 == 1, "20240115_1030 ").otherwise("")
    title = F.concat(prefix, line, F.when(F.col("doc_id") % 4 == 0, " #tag").otherwise(""))
    return table(spark, sf_dir, "documents").select("doc_id", title.alias("title"))


@query(rf"""SELECT doc_id, trim(regexp_replace(regexp_replace(title, '^\s*\d{{4}}[-/.]?\d{{2}}[-/.]?\d{{2}}(?:[T _-]*\d{{2}}:?\d{{2}}(?::?\d{{2}})?)?[\s_:-]*', ''), '#.*$', '')) AS title FROM ({TITLE_SQL})""")
def title_cleanup(spark, sf_dir):
    return titles(spark, sf_dir).select("doc_id", text.clean_title(F.col("title")).alias("title"))


@query(rf"""SELECT doc_id, trim(regexp_replace(regexp_replace(title, '(^|\s)#[^\s#]+', '\1', 'g'), '\s+', ' ', 'g')) AS title FROM ({TITLE_SQL})""")
def hashtag_strip(spark, sf_dir):
    return titles(spark, sf_dir).select("doc_id", text.strip_tags(F.col("title")).alias("title"))


@query(rf"""SELECT doc_id, regexp_replace(substr(regexp_replace(regexp_replace(lower(title), '[^\p{{L}}\p{{N}}]+', '-', 'g'), '^-+|-+$', '', 'g'), 1, 40), '-+$', '') AS slug FROM ({TITLE_SQL})""")
def slug(spark, sf_dir):
    return titles(spark, sf_dir).select("doc_id", text.slug(F.col("title"), 40).alias("slug"))


@query(rf"""WITH s AS (SELECT doc_id, regexp_replace(regexp_replace(lower(nfc_normalize(title)), '[^\p{{L}}\p{{N}}]+', '-', 'g'), '^-+|-+$', '', 'g') AS s FROM ({TITLE_SQL}))
SELECT doc_id, regexp_replace(s[1:list_max(list_filter(range(0, 121), lambda k: strlen(s[1:k]) <= 120))], '^-+|-+$', '', 'g') AS slug FROM s""")
def slug_nfkc(spark, sf_dir):
    return text.nfkc_slugs(titles(spark, sf_dir), "doc_id", "title").select("doc_id", F.col("chunk").alias("slug"))


@query("""SELECT doc_id, text[1:89] AS head, length(text[1:89]) AS n FROM (SELECT doc_id, coalesce(list_filter(list_transform(string_split(text, chr(10)), lambda x: trim(x)), lambda x: x <> '')[1], '') AS text FROM documents)""")
def first_line(spark, sf_dir):
    head = text.first_line(F.col("text"), 89)
    return table(spark, sf_dir, "documents").select("doc_id", head.alias("head"), F.length(head).cast("long").alias("n"))


@query("""WITH t AS (SELECT doc_id, text AS t, CASE WHEN strlen(text) <= 100 THEN text ELSE text[1:list_max(list_filter(range(0, 101), lambda k: strlen(text[1:k]) <= 100))] END AS c FROM documents)
SELECT doc_id, regexp_replace(c, '[-. ]+$', '') AS cut, strlen(regexp_replace(c, '[-. ]+$', '')) AS bytes FROM t""")
def utf8_truncate(spark, sf_dir):
    cut = text.truncate_utf8(F.col("text"), 100)
    return table(spark, sf_dir, "documents").select("doc_id", cut.alias("cut"), F.octet_length(cut).cast("long").alias("bytes"))


@query("""WITH RECURSIVE s AS (SELECT doc_id, text AS t, 0::BIGINT AS pos, NULL::VARCHAR AS piece FROM documents WHERE text <> '' UNION ALL
SELECT doc_id, t[c + 1:], pos + 1, t[1:c] FROM (SELECT doc_id, t, pos, CASE WHEN length(t[1:2000]) + len(regexp_extract_all(t[1:2000], '[^\\x{0}-\\x{FFFF}]')) <= 2000 THEN length(t[1:2000])
  ELSE list_max(list_filter(range(1000, 2001), lambda k: length(t[1:k]) + len(regexp_extract_all(t[1:k], '[^\\x{0}-\\x{FFFF}]')) <= 2000)) END AS c FROM s WHERE t <> ''))
SELECT doc_id, pos - 1 AS pos, md5(piece) AS chunk_md5, length(piece) + len(regexp_extract_all(piece, '[^\\x{0}-\\x{FFFF}]')) AS units FROM s WHERE piece IS NOT NULL""")
def utf16_chunks(spark, sf_dir):
    return text.split_rows(table(spark, sf_dir, "documents"), "doc_id", "text", text.utf16_chunks).select("doc_id", "pos", F.md5("chunk").alias("chunk_md5"), text.utf16_units(F.col("chunk")).alias("units"))


@query("""WITH RECURSIVE s AS (SELECT doc_id, text AS t, 0::BIGINT AS pos, NULL::VARCHAR AS piece FROM documents WHERE text <> '' UNION ALL
SELECT doc_id, t[c + 1:], pos + 1, t[1:c] FROM (SELECT doc_id, t, pos, CASE WHEN length(t) <= 1800 THEN length(t) WHEN contains(t[401:1800], chr(10)) THEN 1801 - instr(reverse(t[401:1800]), chr(10)) WHEN contains(t[401:1800], ' ') THEN 1801 - instr(reverse(t[401:1800]), ' ') ELSE 1800 END AS c FROM s WHERE t <> ''))
SELECT doc_id, pos - 1 AS pos, length(piece) AS n, md5(piece) AS chunk_md5 FROM s WHERE piece IS NOT NULL""")
def soft_chunks(spark, sf_dir):
    return text.split_rows(table(spark, sf_dir, "documents"), "doc_id", "text", text.soft_chunks).select("doc_id", "pos", F.length("chunk").cast("long").alias("n"), F.md5("chunk").alias("chunk_md5"))


#: Markdown before each text: every kind of block, a table of 100 rows, fences, nested items (fixed values).
MARKED = "---\ntitle: x\n---\n# Head #\n\n#### deep\n- one\n  - two\n\t\t- three\n1. first\nfor\n> said\n>more\n***\na | b\nc|d\\|e\n---|:--:\nf\n```py\n|x|\n|--|--|\n# no\n```\n```\n\n|h|i|\n|---|---|\n" + "".join(f"| {i} | v{i} |\n" for i in range(100)) + "last|\n\n"


@query(r"""WITH t AS (SELECT doc_id, regexp_replace('# Head #' || chr(10) || split_part($m$@$m$, '# Head #' || chr(10), 2) || coalesce(text, ''), '\r\n?', chr(10), 'g') AS t FROM documents),
l AS (SELECT doc_id, unnest(string_split(t, chr(10))) AS line, generate_subscripts(string_split(t, chr(10)), 1) AS i FROM t),
f AS (SELECT *, starts_with(line, '```') AS fence, sum(starts_with(line, '```')::INT) OVER (PARTITION BY doc_id ORDER BY i) AS seg FROM l),
p AS (SELECT *, NOT fence AND seg % 2 = 0 AND contains(line, '|') AND NOT regexp_full_match(line, '\s*') AS bar FROM f WHERE fence OR seg % 2 = 0 OR true),
r AS (SELECT *, i - row_number() OVER (PARTITION BY doc_id, seg, bar ORDER BY i) AS run, bar AND lead(bar) OVER w AND regexp_full_match(lead(line) OVER w, '\s*\|*\s*:?-{3,}:?\s*(?:\|\s*:?-{3,}:?\s*)+\|*\s*') AS head FROM p WINDOW w AS (PARTITION BY doc_id, seg ORDER BY i)),
k AS (SELECT *, CASE WHEN fence OR seg % 2 = 1 THEN 'code' WHEN bar AND sum(head::INT) OVER (PARTITION BY doc_id, seg, bar, run ORDER BY i) > 0 THEN 'table' WHEN regexp_full_match(line, '\s*') THEN 'blank' WHEN regexp_matches(line, '^#{1,6}\s+') THEN 'heading'
  WHEN regexp_full_match(line, '\s*(?:---|___|\*\*\*)\s*') THEN 'divider' WHEN regexp_matches(line, '^[ \t]*[-*]\s+') THEN 'bullet' WHEN regexp_matches(line, '^[ \t]*\d+\.\s+') THEN 'number' WHEN starts_with(line, '>') THEN 'quote' ELSE 'paragraph' END AS kind FROM r),
g AS (SELECT *, sum((kind IN ('heading', 'divider', 'bullet', 'number') OR kind IS DISTINCT FROM before OR kind = 'code' AND fence AND seg % 2 = 1)::INT) OVER (PARTITION BY doc_id ORDER BY i) AS grp FROM (SELECT *, lag(kind) OVER (PARTITION BY doc_id ORDER BY i) AS before FROM k)),
b AS (SELECT doc_id, grp, kind, min(i) AS i, list(line ORDER BY i) AS x FROM g WHERE kind <> 'blank' AND NOT (kind = 'code' AND fence AND seg % 2 = 0) GROUP BY ALL),
c AS (SELECT *, list_transform(list_filter(x, lambda y, n: n <> 2), lambda y: list_transform(string_split(regexp_replace(regexp_replace(regexp_replace(replace(y, '\|', chr(1)), '^\s+|\s+$', '', 'g'), '^\|+', ''), '\|+$', ''), '|'), lambda z: replace(regexp_replace(z, '^\s+|\s+$', '', 'g'), chr(1), '|'))) AS rows FROM b WHERE kind = 'table'),
w AS (SELECT *, list_max(list_transform(rows, lambda r: len(r))) AS width FROM c), e AS (SELECT *, list_transform(rows, lambda r: list_resize(r, width, '')) AS even, unnest(range(0, greatest(1, len(rows) - 1), 80)) AS o FROM w),
a AS (SELECT doc_id, i, o, 'table' AS type, width AS level, '' AS lang, to_json(list_concat(even[1:1], even[o + 2:o + 81]))::VARCHAR AS text FROM e
  UNION ALL SELECT doc_id, i, 0, kind, CASE WHEN kind = 'heading' THEN least(3, length(regexp_extract(x[1], '^#+'))) WHEN kind IN ('bullet', 'number') THEN length(replace(regexp_extract(x[1], '^[ \t]*'), chr(9), '  ')) // 2 ELSE 0 END,
  CASE WHEN kind = 'code' THEN coalesce(nullif(regexp_replace(x[1][4:], '^\s+|\s+$', '', 'g'), ''), 'plain text') ELSE '' END,
  CASE kind WHEN 'code' THEN array_to_string(x[2:], chr(10)) WHEN 'divider' THEN '' WHEN 'heading' THEN regexp_replace(regexp_replace(x[1], '^#{1,6}\s+', ''), '^\s+|\s+$', '', 'g') WHEN 'bullet' THEN regexp_replace(regexp_replace(x[1], '^[ \t]*[-*]\s+', ''), '^\s+|\s+$', '', 'g')
  WHEN 'number' THEN regexp_replace(regexp_replace(x[1], '^[ \t]*\d+\.\s+', ''), '^\s+|\s+$', '', 'g') WHEN 'quote' THEN regexp_replace(array_to_string(list_transform(x, lambda y: regexp_replace(y, '^>\s?', '')), chr(10)), '^\s+|\s+$', '', 'g')
  ELSE regexp_replace(array_to_string(list_transform(x, lambda y: regexp_replace(y, '\s+$', '')), chr(10)), '^\s+|\s+$', '', 'g') END FROM b WHERE kind <> 'table'
  UNION ALL SELECT doc_id, -2, 0, 'heading', 3, '', 'Frontmatter' FROM documents UNION ALL SELECT doc_id, -1, 0, 'code', 0, 'yaml', 'title: x' FROM documents)
SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY i, o) - 1 AS pos, type, level::INT AS level, lang, md5(text) AS content_md5 FROM a""".replace("@", MARKED))
def markdown_blocks(spark, sf_dir):
    """Typed blocks of whole texts behind a text that has every kind."""
    marked = F.concat(F.lit(MARKED), F.coalesce("text", F.lit("")))
    rows = table(spark, sf_dir, "documents").select("doc_id", F.posexplode(markdown.markdown_blocks(marked, "nested")).alias("pos", "b"))
    return rows.select("doc_id", F.col("pos").cast("long").alias("pos"), "b.type", "b.level", "b.lang", F.md5("b.text").alias("content_md5"))


LINK_SQL = "SELECT doc_id, 'see https://a.example.com/' || doc_id || '?x=1, then http://b.example.org/p. ' || text || ' https://a.example.com/' || doc_id || '?x=1' AS t FROM documents"


@query(rf"""SELECT doc_id, array_to_string(l, ' ') AS urls, len(l) AS n FROM (SELECT doc_id, list_transform(regexp_extract_all(t, 'https?://[^\s<>"'')\]]+'), lambda u: regexp_replace(u, '[.,;:!?]+$', '')) AS a,
list_filter(a, lambda x, i: list_position(a, x) = i) AS l FROM ({LINK_SQL}))""")
def url_extract(spark, sf_dir):
    t = F.concat(F.lit("see https://a.example.com/"), F.col("doc_id").cast("string"), F.lit("?x=1, then http://b.example.org/p. "), F.col("text"), F.lit(" https://a.example.com/"), F.col("doc_id").cast("string"), F.lit("?x=1"))
    found = text.urls(t)
    return table(spark, sf_dir, "documents").select("doc_id", F.array_join(found, " ").alias("urls"), F.size(found).cast("long").alias("n"))


@query(r"""SELECT doc_id, substr(trim(regexp_replace(CASE WHEN length(text) > 80 THEN regexp_replace(regexp_replace(text, '\b\d{12,19}\b', '[number]', 'g'), '\b\d{3,4}\b', '[code]', 'g') ELSE regexp_replace(text, '\b\d{12,19}\b', '[number]', 'g') END, '\s+', ' ', 'g')), 1, 180) AS preview FROM documents""")
def preview_redaction(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", text.redacted_preview(F.col("text")).alias("preview"))


#: Shapes of credentials whose texts are held (fixed values); none stands inside a longer word.
SHAPES = [r"gh[pousr]_[A-Za-z0-9]{30,}", r"github_pat_[A-Za-z0-9_]{30,}", r"sk-[A-Za-z0-9_-]{20,}", r"ntn_[A-Za-z0-9]{30,}", r"secret_[A-Za-z0-9]{30,}", r"AKIA[0-9A-Z]{16}"]
KEY_BLOCK = r"-----BEGIN (?:RSA |EC |DSA |OPENSSH |ENCRYPTED )?PRIVATE KEY-----"
HELD = rf"(?:^|[^A-Za-z0-9_])(?:{'|'.join(SHAPES)})(?:$|[^A-Za-z0-9_])|{KEY_BLOCK}"
#: A sample of each shape, put behind every eleventh text, whole or one character short.
SAMPLES = ["ghp_" + "aB3" * 10, "github_pat_" + "x_9" * 10, "sk-" + "k-_7" * 5, "ntn_" + "Z9" * 15, "secret_" + "q0" * 15, "AKIA" + "Z9" * 8, "-----BEGIN EC PRIVATE KEY-----", "xghp_" + "aB3" * 10]
SAMPLE_SQL = "CASE doc_id % 11 " + " ".join(f"WHEN {i} THEN ' {x}'" for i, x in enumerate(SAMPLES)) + " ELSE '' END"


@query(f"""WITH t AS (SELECT doc_id, coalesce(text, '') || CASE WHEN doc_id % 22 >= 11 THEN left({SAMPLE_SQL}, -1) ELSE {SAMPLE_SQL} END AS t FROM documents)
SELECT doc_id, CASE WHEN regexp_matches(t, '{HELD}') THEN 'held' ELSE 'passed' END AS outcome FROM t""")
def secret_hold(spark, sf_dir):
    """Documents with a credential's shape are held before any write."""
    docs, d = table(spark, sf_dir, "documents"), F.col("doc_id")
    sample = F.coalesce(F.get(F.array(*(F.lit(" " + x) for x in SAMPLES)), (d % 11).cast("int")), F.lit(""))
    given = F.when(d % 22 >= 11, F.left(sample, F.greatest(F.length(sample) - 1, F.lit(0)))).otherwise(sample)
    return docs.select("doc_id", F.when(F.concat(F.coalesce("text", F.lit("")), given).rlike(HELD), "held").otherwise("passed").alias("outcome"))


@query(r"""SELECT page_id, trim(regexp_replace(replace(replace(replace(replace(replace(regexp_replace(regexp_replace(html, '<(script|style)\b.*?</(script|style)>|<!--.*?-->', ' ', 'gis'), '<[^>]*>', ' ', 'g'), '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&nbsp;', ' '), '&amp;', '&'), '\s+', ' ', 'g')) AS body FROM pages""")
def html_to_text(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", text.html_text(F.col("html")).alias("body"))


@query(r"""SELECT page_id, regexp_extract(html, '<title>([^<]*)</title>', 1) AS title, regexp_extract(html, '<html lang="([a-z]+)"', 1) AS lang, CAST(len(regexp_extract_all(html, '<a href=')) AS BIGINT) AS links FROM pages""")
def html_meta(spark, sf_dir):
    html = table(spark, sf_dir, "pages")
    return html.select("page_id", F.regexp_extract("html", "<title>([^<]*)</title>", 1).alias("title"), F.regexp_extract("html", '<html lang="([a-z]+)"', 1).alias("lang"), F.regexp_count("html", F.lit("<a href=")).cast("long").alias("links"))


@query("""SELECT doc_id, CASE WHEN doc_id % 5 <> 4 THEN 'doc-' || doc_id END AS id, CASE WHEN doc_id % 5 IN (1, 3) THEN 'xx' WHEN doc_id % 5 <> 4 THEN lang END AS lang, CAST(CASE doc_id % 5 WHEN 4 THEN 0 WHEN 2 THEN 4 ELSE 3 END AS BIGINT) AS fields FROM documents""")
def frontmatter_parse(spark, sf_dir):
    """Heads rendered from the columns and parsed again: keys twice, values with colons, other line ends, no head."""
    k = F.col("doc_id") % 5
    head = F.concat(F.lit("---\nid: doc-"), F.col("doc_id").cast("string"), F.lit("\nlang: "), F.col("lang"), F.lit("\nsource: "), F.col("source"))
    tail = F.when(k == 1, "\nlang: xx\n---\n").when(k == 2, "\nurl: https://a.example/x: y\n---\n").when(k == 3, "\nlang: xx\n  indented: no\n---\n").otherwise("\n---\n")
    made = F.concat(F.when(k == 4, F.replace(head, F.lit("---\n"), F.lit(""))).when(k == 3, F.replace(head, F.lit("\n"), F.lit("\r\n"))).otherwise(head), tail, F.col("text"))
    parsed = table(spark, sf_dir, "documents").select("doc_id", text.front_matter(made).alias("m"))
    return parsed.select("doc_id", F.col("m")["id"].alias("id"), F.col("m")["lang"].alias("lang"), F.size("m").cast("long").alias("fields"))


STAMP_SQL = """SELECT event_id, ts, CASE event_id % 5 WHEN 0 THEN strftime(ts, '%Y-%m-%dT%H:%M:%S') WHEN 1 THEN strftime(ts, '%Y-%m-%dT%H:%M:%SZ') WHEN 2 THEN CAST(epoch_ms(ts) // 1000 AS VARCHAR)
WHEN 3 THEN CAST(epoch_ms(ts) AS VARCHAR) ELSE strftime(ts, '%Y-%m-%d') END AS stamp FROM events"""


@query(f"""SELECT event_id, CASE event_id % 5 WHEN 0 THEN 'naive' WHEN 1 THEN 'zoned' WHEN 2 THEN 'seconds' WHEN 3 THEN 'millis' ELSE 'date' END AS form,
strftime(CASE event_id % 5 WHEN 0 THEN date_trunc('second', ts) - INTERVAL 8 HOUR WHEN 4 THEN date_trunc('day', ts) - INTERVAL 8 HOUR ELSE date_trunc('second', ts) END, '%Y-%m-%d %H:%M:%S') AS at FROM ({STAMP_SQL})""")
def mixed_timestamp_parse(spark, sf_dir):
    ts, k = F.col("ts"), F.col("event_id") % 5
    utc = F.to_utc_timestamp(ts.cast("timestamp"), "UTC")
    stamp = (
        F.when(k == 0, F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")).when(k == 1, F.concat(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss"), F.lit("Z")))
        .when(k == 2, F.unix_seconds(utc).cast("string")).when(k == 3, F.unix_millis(utc).cast("string")).otherwise(F.date_format(ts, "yyyy-MM-dd"))
    )
    rows = table(spark, sf_dir, "events").select("event_id", stamp.alias("stamp"))
    return rows.select("event_id", dates.form_of(F.col("stamp")).alias("form"), F.date_format(dates.parse_time(F.col("stamp")), "yyyy-MM-dd HH:mm:ss").alias("at"))


@query("""SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS day, isoyear(o_orderdate) || '-W' || lpad(CAST(week(o_orderdate) AS VARCHAR), 2, '0') AS week, strftime(date_trunc('week', o_orderdate) - INTERVAL 7 DAY, '%Y-%m-%d') AS previous_monday FROM orders""")
def period_labels(spark, sf_dir):
    day = F.to_date("o_orderdate")
    monday = F.date_add(F.to_date(F.date_trunc("week", "o_orderdate")), -7)
    return table(spark, sf_dir, "orders").select("o_orderkey", F.date_format(day, "yyyy-MM-dd").alias("day"), dates.iso_week(day).alias("week"), F.date_format(monday, "yyyy-MM-dd").alias("previous_monday"))


@query("""SELECT event_id, json_extract_string(props, '$.k') AS k, len(json_keys(props)) AS n_keys, sha256(props) AS digest FROM events""")
def json_props_project(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    bag = F.from_json("props", "map<string,string>")
    return events.select("event_id", F.get_json_object("props", "$.k").alias("k"), F.size(bag).cast("long").alias("n_keys"), F.sha2("props", 256).alias("digest"))


@query("""SELECT doc_id, sha256('{"lang":"' || lang || '","source":"' || source || '","z":' || doc_id || '}') AS digest FROM documents""")
def canonical_digest(spark, sf_dir):
    row = hashing.canonical_json(source=F.col("source"), z=F.col("doc_id"), lang=F.col("lang"))
    return table(spark, sf_dir, "documents").select("doc_id", F.sha2(row, 256).alias("digest"))


@query("""SELECT doc_id, sha1(CAST('blob ' || strlen(text) AS BLOB) || '\\x00'::BLOB || encode(text)) AS blob FROM documents""")
def blob_identity(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", hashing.blob_sha1(F.col("text")).alias("blob"))


@query("""WITH d AS (SELECT strftime(d, '%Y-%m-%d') AS day FROM (SELECT unnest(range(TIMESTAMP '2024-01-10', TIMESTAMP '2024-01-20', INTERVAL 1 DAY)) AS d))
SELECT d.day, count(e.event_id) AS n FROM d LEFT JOIN events e ON strftime(e.ts, '%Y-%m-%d') = d.day GROUP BY d.day""")
def day_partitions(spark, sf_dir):
    """A scan by day over an inclusive range of dates; days without rows count zero."""
    days = spark.sql("SELECT explode(sequence(DATE'2024-01-10', DATE'2024-01-19')) AS day").select(F.date_format("day", "yyyy-MM-dd").alias("day"))
    counts = table(spark, sf_dir, "events").groupBy(F.date_format("ts", "yyyy-MM-dd").alias("day")).agg(F.count("*").alias("n"))
    return days.join(counts, "day", "left").select("day", F.coalesce("n", F.lit(0)).alias("n"))


@query(r"""SELECT page_id, array_to_string(list_filter(r, lambda x, i: list_position(r, x) = i AND NOT regexp_matches(x, '^(?:[A-Za-z][A-Za-z0-9+.-]*:|//|#)')), ' ') AS refs FROM (SELECT page_id, list_concat(
regexp_extract_all(html, '(?:src|href)="([^"]+)"', 1), ['b.png', 'c.png', 'img/x.png', 'theme.css']) AS r FROM pages)""")
def bundle_references(spark, sf_dir):
    """Local files that a page needs: attributes, srcset, CSS url() and @import; each once, in order of dialect."""
    made = F.concat("html", F.lit("<img srcset=\"b.png 1x, c.png 2x\"><style>@import 'theme.css'; p{background:url(img/x.png)}</style>"))
    return table(spark, sf_dir, "pages").select("page_id", F.array_join(text.local_references(made), " ").alias("refs"))


@query("""SELECT doc_id, CASE doc_id % 5 WHEN 0 THEN 'wiki' WHEN 1 THEN 'link' WHEN 2 THEN 'code' WHEN 3 THEN 'wiki' ELSE 'text' END AS kind, CASE doc_id % 5 WHEN 0 THEN source || '/note' WHEN 1 THEN source || '/a.md' WHEN 2 THEN source || '.py' WHEN 3 THEN source ELSE source || ' plain' END AS target,
CASE doc_id % 5 WHEN 0 THEN 'shown' WHEN 1 THEN 'label' WHEN 2 THEN source || '.py' WHEN 3 THEN source ELSE source || ' plain' END AS label FROM documents""")
def markdown_references(spark, sf_dir):
    k, s = F.col("doc_id") % 5, F.col("source")
    raw = (
        F.when(k == 0, F.concat(F.lit("- [["), s, F.lit("/note#part|shown]]"))).when(k == 1, F.concat(F.lit("[label]("), s, F.lit("/a.md)"))).when(k == 2, F.concat(F.lit("`"), s, F.lit(".py`")))
        .when(k == 3, F.concat(F.lit("[["), s, F.lit("]]"))).otherwise(F.concat(F.lit("* "), s, F.lit(" plain")))
    )
    return table(spark, sf_dir, "documents").select("doc_id", text.reference(raw).alias("r")).select("doc_id", "r.kind", "r.target", "r.label")


@query(r"""SELECT doc_id, lang || chr(10) || chr(10) || source || ' end' AS body FROM documents""")
def body_normalised(spark, sf_dir):
    """Line ends made one, written escapes too, a leading title and blank runs out."""
    raw = F.concat(F.lit("# Title\r\n\r\nTitle\n"), F.col("lang"), F.lit("\\n\n\n\r\n"), F.col("source"), F.lit(" end \r\n\n"))
    return table(spark, sf_dir, "documents").select("doc_id", text.normal_body(F.lit("Title"), raw).alias("body"))


@query(r"""SELECT page_id, CASE WHEN page_id % 3 = 2 THEN NULL ELSE lower(regexp_extract(url, '^(https?)://', 1)) || '://' || regexp_replace(lower(regexp_extract(url, '^https?://([^/?#]+)', 1)), '^www[.]', '') || regexp_extract(url, '^https?://[^/?#]+([^?#]*?)/?(?:[?#]|$)', 1) END AS normal
FROM (SELECT page_id, CASE WHEN page_id % 3 = 0 THEN 'HTTPS://WWW.Example.COM/a/' || page_id || '/?x=1#t' WHEN page_id % 3 = 1 THEN 'http://b.example.org' ELSE 'mailto:x' END AS u0, CASE WHEN page_id % 3 = 0 THEN 'https://www.Example.COM/a/' || page_id || '/?x=1#t' WHEN page_id % 3 = 1 THEN 'http://b.example.org' ELSE 'mailto:x' END AS url FROM pages)""")
def url_normalised(spark, sf_dir):
    k = F.col("page_id") % 3
    url = F.when(k == 0, F.concat(F.lit("HTTPS://WWW.Example.COM/a/"), F.col("page_id").cast("string"), F.lit("/?x=1#t"))).when(k == 1, "http://b.example.org").otherwise("mailto:x")
    return table(spark, sf_dir, "pages").select("page_id", text.normal_url(url).alias("normal"))


@query("""SELECT doc_id, CASE WHEN doc_id % 4 = 0 THEN '' ELSE source || ',' || lang || ',x' END AS tags FROM documents""")
def tag_directive(spark, sf_dir):
    """Tags after the last marker of a text, each once."""
    d = F.col("doc_id")
    said = F.concat(F.lit("text tags: old, tags: "), F.col("source"), F.lit(", "), F.col("lang"), F.lit(" and "), F.col("source"), F.lit("; #x."))
    return table(spark, sf_dir, "documents").select("doc_id", F.array_join(text.requested_tags(F.when(d % 4 != 0, said).otherwise("no marker"), "tags:"), ",").alias("tags"))


@query(r"""SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN 'untitled' ELSE 'a_b_c ' || source END AS file_name, CASE WHEN doc_id % 3 = 0 THEN '' ELSE 'a/b:c  ' || source || '.' END AS title,
replace(replace(replace('[' || source || '](x) *' || lang || '*', '[', chr(92) || '['), ']', chr(92) || ']'), '*', chr(92) || '*') AS label FROM documents""")
def safe_names(spark, sf_dir):
    title = F.when(F.col("doc_id") % 3 == 0, "").otherwise(F.concat(F.lit("a/b:c  "), F.col("source"), F.lit(".")))
    label = F.concat(F.lit("["), F.col("source"), F.lit("](x) *"), F.col("lang"), F.lit("*"))
    return table(spark, sf_dir, "documents").select("doc_id", text.file_name(title, 90).alias("file_name"), title.alias("title"), text.escaped_label(label).alias("label"))


@query("""SELECT doc_id, CASE doc_id % 6 WHEN 0 THEN 'image/png' WHEN 1 THEN 'image/jpeg' WHEN 2 THEN 'application/pdf' WHEN 3 THEN 'image/webp' WHEN 4 THEN 'application/zip' ELSE 'application/octet-stream' END AS mime FROM documents""")
def mime_sniff(spark, sf_dir):
    heads = F.array(*(F.lit(h) for h in ("89504E470D0A1A0A", "FFD8FFE0", "255044462D", "5249464600000000574542505650", "504B0304", "00")))
    content = F.concat(F.unhex(F.get(heads, (F.col("doc_id") % 6).cast("int"))), F.encode("text", "UTF-8"))
    return table(spark, sf_dir, "documents").select("doc_id", text.mime_of(F.when(F.col("doc_id") % 6 == 5, F.unhex(F.lit("0001"))).otherwise(content)).alias("mime"))


@query("""SELECT doc_id, '---' || chr(10) || 'id: ' || doc_id || chr(10) || 'lang: ' || lang || chr(10) || 'source: ' || source || chr(10) || '---' || chr(10) AS head FROM documents""")
def frontmatter_render(spark, sf_dir):
    fields = F.create_map(F.lit("source"), F.col("source"), F.lit("id"), F.col("doc_id").cast("string"), F.lit("lang"), F.col("lang"))
    return table(spark, sf_dir, "documents").select("doc_id", text.render_front_matter(fields).alias("head"))


@query("""WITH s AS (SELECT doc_id, [struct_pack(heading := '', body := 'lead ' || lang, items := 0), struct_pack(heading := 'One', body := source || ' first', items := 0), struct_pack(heading := 'Two', body := '- a' || chr(10) || '- b', items := 2)] AS r FROM documents),
e AS (SELECT doc_id, unnest(r) AS x, generate_subscripts(r, 1) - 1 AS pos FROM s) SELECT doc_id, CAST(pos AS BIGINT) AS pos, x.heading AS heading, x.body AS body, CAST(x.items AS BIGINT) AS items FROM e""")
def markdown_sections(spark, sf_dir):
    """Sections of a Markdown text: heading, body, number of list items."""
    made = F.concat(F.lit("lead "), F.col("lang"), F.lit("\n## One\n"), F.col("source"), F.lit(" first\n\n## Two\n- a\n- b\n"))
    each = table(spark, sf_dir, "documents").select("doc_id", F.posexplode(text.sections(made)).alias("pos", "s"))
    return each.select("doc_id", F.col("pos").cast("long").alias("pos"), "s.heading", "s.body", F.size(F.filter(F.split("s.body", "\n"), lambda x: x.rlike("^[-*] "))).cast("long").alias("items"))


@query("""SELECT doc_id, CASE WHEN doc_id % 4 = 1 THEN NULL ELSE CAST(8 AS BIGINT) + length(lang) END AS start, CASE WHEN doc_id % 4 = 1 THEN NULL ELSE length(source) END AS length, CASE WHEN doc_id % 4 = 1 THEN NULL ELSE strlen(source) END AS bytes FROM documents""")
def region_slots(spark, sf_dir):
    """The slot between two markers that each stand once in a text; else none."""
    d = F.col("doc_id")
    made = F.concat("lang", F.lit("<!--a-->"), "source", F.lit("<!--b-->"), F.when(d % 4 == 1, "<!--a-->").otherwise(""))
    slot = text.region(made, "<!--a-->", "<!--b-->")
    return table(spark, sf_dir, "documents").select("doc_id", slot.alias("s")).select("doc_id", (F.col("s.start") - 1).alias("start"), "s.length", "s.bytes")


@query("""SELECT o_orderkey, CASE WHEN h > 0 THEN h || '小时' ELSE '' END || CASE WHEN m > 0 THEN m || '分' ELSE '' END || CASE WHEN s > 0 OR h = 0 AND m = 0 THEN s || '秒' ELSE '' END AS spoken
FROM (SELECT o_orderkey, t // 3600 AS h, t % 3600 // 60 AS m, t % 60 AS s FROM (SELECT o_orderkey, CAST(round_even(floor(o_totalprice) / 2.0, 0) AS BIGINT) AS t FROM orders))""")
def spoken_duration(spark, sf_dir):
    return table(spark, sf_dir, "orders").select("o_orderkey", numbers.spoken_seconds(F.floor("o_totalprice") / 2).alias("spoken"))


@query("""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, greatest(0, least(100, CASE WHEN l_discount * 20 <= 1 THEN l_discount * 2000 ELSE l_discount * 20 END)) AS percent, abs(l_partkey - l_suppkey) * 10 < 1000 AS near FROM lineitem""")
def progress_and_tolerance(spark, sf_dir):
    progress = F.col("l_discount") * 20
    percent = F.greatest(F.lit(0), F.least(F.lit(100), F.when(progress <= 1, F.col("l_discount") * 2000).otherwise(progress)))
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", percent.alias("percent"), numbers.near(F.col("l_partkey") * 10, F.col("l_suppkey") * 10).alias("near"))


@query("""SELECT event_id, strftime(date_trunc('minute', ts), '%Y-%m-%dT%H:%M') AS wire, strftime(ts, '%Y年%-m月%-d日') AS read_as, strftime(CASE WHEN event_id % 2 = 0 THEN ts - INTERVAL 3 DAY ELSE TIMESTAMP '2024-02-01' - INTERVAL 7 DAY END, '%Y-%m-%d %H:%M:%S') AS since FROM events""")
def stamps_for_readers(spark, sf_dir):
    """A stamp to the minute, as a reader's date, and where a next read starts (3 days of overlap, else 7 back)."""
    ts, now = F.col("ts").cast("timestamp"), F.lit("2024-02-01").cast("timestamp")
    since = dates.window_start(F.when(F.col("event_id") % 2 == 0, ts), now, 3, 7)
    return table(spark, sf_dir, "events").select("event_id", F.date_format(F.date_trunc("minute", ts), "yyyy-MM-dd'T'HH:mm").alias("wire"), F.date_format(ts, "yyyy年M月d日").alias("read_as"), F.date_format(since, "yyyy-MM-dd HH:mm:ss").alias("since"))


@query("""SELECT event_id, greatest(least(30.0, 0.5 * pow(2, event_id % 8)) * (0.5 + 0.5 * (event_id % 11) / 10), CASE WHEN event_id % 3 = 0 THEN 2.0 ELSE 0.0 END) AS delay FROM events""")
def retry_delays(spark, sf_dir):
    """Delays before a next try: doubled up to a limit, jitter down to half, never below what the server asked for."""
    e = F.col("event_id")
    delay = numbers.retry_delay(e % 8 + 1, (e % 11) / 10, F.when(e % 3 == 0, 2.0))
    return table(spark, sf_dir, "events").select("event_id", delay.alias("delay"))


@query(r"""WITH r AS (SELECT event_id, CASE event_id % 5 WHEN 0 THEN props WHEN 1 THEN left(props, -1) WHEN 2 THEN '{"k":[],' || props[2:] WHEN 3 THEN '{"a":"' || repeat(event_type, event_id % 60) || '"}' ELSE '[' || props || ',{"b":' || props || '}]' END AS raw FROM events)
SELECT event_id, CASE WHEN strlen(raw) > 200 THEN 'too_large' WHEN NOT json_valid(raw) THEN 'malformed' WHEN len(list_distinct(k)) < len(k) THEN 'duplicate_key' ELSE 'accepted' END AS outcome FROM (SELECT *, regexp_extract_all(CASE WHEN raw LIKE '{%' THEN raw END, '"([a-z]+)":', 1) AS k FROM r)""")
def strict_json(spark, sf_dir):
    """Properties of events as JSON that a capture accepts: well formed, no key twice, within its size."""
    e, props = F.col("event_id"), F.col("props")
    raw = (
        F.when(e % 5 == 0, props).when(e % 5 == 1, F.left(props, F.length(props) - 1)).when(e % 5 == 2, F.concat(F.lit('{"k":[],'), F.substr(props, F.lit(2), F.length(props))))
        .when(e % 5 == 3, F.concat(F.lit('{"a":"'), F.expr("repeat(event_type, cast(event_id % 60 AS int))"), F.lit('"}'))).otherwise(F.concat(F.lit("["), props, F.lit(',{"b":'), props, F.lit("}]")))
    )
    return table(spark, sf_dir, "events").select("event_id", text.json_outcome(raw, 200).alias("outcome"))


THEME_WORDS = ("with", "from", "ción", "über", "license")
THEME_WORDS_SQL = ", ".join(f"CASE WHEN regexp_matches(lower(text), '(^|[^a-z0-9]){w}($|[^a-z0-9])') THEN '{w}' END" if w.isascii() else f"CASE WHEN contains(lower(text), '{w}') THEN '{w}' END" for w in THEME_WORDS)


@query(f"""SELECT doc_id, array_to_string(list_filter([{THEME_WORDS_SQL}], lambda x: x IS NOT NULL), ',') AS themes FROM documents""")
def script_aware_themes(spark, sf_dir):
    """Theme words of whole texts: ASCII ones only between other characters than letters and digits, others anywhere."""
    return table(spark, sf_dir, "documents").select("doc_id", F.array_join(text.keywords_in(F.col("text"), THEME_WORDS), ",").alias("themes"))


RULES = [("/de/", "foreign", "translate", "medium"), ("/fr/", "foreign", "translate", "medium"), ("/en/", "local", "keep", "low")]
RULE_VALUES = ", ".join(f"({i}, '{p}', '{g}', '{r}', '{k}')" for i, (p, g, r, k) in enumerate(RULES))


@query(rf"""WITH r(i, part, grp, advice, risk) AS (VALUES {RULE_VALUES}), h AS (SELECT page_id, i, grp, advice, risk, row_number() OVER (PARTITION BY page_id ORDER BY i NULLS LAST) AS k
FROM pages LEFT JOIN r ON contains(coalesce(url, ''), part)) SELECT page_id, coalesce(grp, 'other') AS "group", coalesce(advice, 'review') AS advice, coalesce(risk, 'high') AS risk FROM h WHERE k = 1""")
def rule_table(spark, sf_dir):
    """Places classified by the first rule of an ordered table that fits."""
    out = F.struct(F.lit("other").alias("group"), F.lit("review").alias("advice"), F.lit("high").alias("risk"))
    for part, *fields in reversed(RULES):
        out = F.when(F.contains(F.coalesce("url", F.lit("")), F.lit(part)), F.struct(*(F.lit(f).alias(n) for f, n in zip(fields, ("group", "advice", "risk"), strict=True)))).otherwise(out)
    return table(spark, sf_dir, "pages").select("page_id", out.alias("r")).select("page_id", "r.group", "r.advice", "r.risk")


@query()
def html_to_markdown(spark, sf_dir):
    """Pages as Markdown: headings, lists, links, quotes, emphasis and code by a stack of open elements."""
    return html_markdown.html_markdown(table(spark, sf_dir, "pages"), "page_id", "html")
