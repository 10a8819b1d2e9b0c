"""Queries over pages, paths and blocks of notes: summaries, listings, rendering, pairing."""

from __future__ import annotations

from pyspark.sql import functions as F

from siltworks.functions import notes, text
from siltworks.operators import ranking as ranking_ops
from siltworks.plans.registry import query, table


@query(r"""SELECT page_id, regexp_extract(h, '<title>([^<]*)</title>', 1) AS title, CASE page_id % 3 WHEN 0 THEN 'about ' || page_id ELSE '' END AS description, CASE page_id % 3 WHEN 2 THEN '' ELSE 'card "' || page_id || '"' END AS og_title,
substr(trim(regexp_replace(replace(replace(replace(replace(replace(regexp_replace(regexp_replace(h, '<(script|style)\b.*?</(script|style)>|<!--.*?-->', ' ', 'gis'), '<[^>]*>', ' ', 'g'), '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&nbsp;', ' '), '&amp;', '&'), '\s+', ' ', 'g')), 1, 1200) AS excerpt
FROM (SELECT page_id, coalesce(html, '') AS h FROM pages)""")
def page_summary(spark, sf_dir):
    """Title, description and card title of a page, and the first 1,200 characters of its text."""
    number = F.col("page_id").cast("string")
    card = F.concat(F.lit("<META content='card \""), number, F.lit("\"' property='og:title'>"))
    about = F.concat(F.lit('<meta data-name="x" name="description" content="about '), number, F.lit('">'))
    head = F.when(F.col("page_id") % 3 == 0, F.concat(card, about)).when(F.col("page_id") % 3 == 1, card).otherwise('<meta name="author" content="none">')
    pages = table(spark, sf_dir, "pages").select("page_id", F.concat(head, F.coalesce("html", F.lit(""))).alias("h"))
    title = F.regexp_extract("h", "<title>([^<]*)</title>", 1)
    return pages.select("page_id", title.alias("title"), notes.meta_content(F.col("h"), "name", "description").alias("description"), notes.meta_content(F.col("h"), "property", "og:title").alias("og_title"), F.left(text.html_text(F.col("h")), F.lit(1200)).alias("excerpt"))


@query("""WITH p AS (SELECT page_id, CASE page_id % 3 WHEN 0 THEN 'en/' WHEN 1 THEN 'de/notes/' ELSE '' END || CASE WHEN page_id % 2 = 0 THEN 'p' || page_id % 10 ELSE 'page' || page_id END || CASE WHEN page_id % 5 = 0 THEN '.txt' ELSE '.md' END AS path FROM pages)
SELECT page_id, path FROM p WHERE (ends_with(path, '.md') OR starts_with(path, 'en/')) AND NOT regexp_matches(path, '(^|/)p[^/][.]md$') AND NOT regexp_matches(path, '^de/[^/]*/page1[^/]*$')""")
def tracked_paths(spark, sf_dir):
    """Paths that fit globs of the listing and none of those left out."""
    k = F.col("page_id")
    name = F.when(k % 2 == 0, F.concat(F.lit("p"), (k % 10).cast("string"))).otherwise(F.concat(F.lit("page"), k.cast("string")))
    path = F.concat(F.when(k % 3 == 0, "en/").when(k % 3 == 1, "de/notes/").otherwise(""), name, F.when(k % 5 == 0, ".txt").otherwise(".md"))
    wanted = notes.tracked(F.col("path"), ("**/*.md", "en/**"), ("**/p?.md", "de/*/page1*"))
    return table(spark, sf_dir, "pages").select("page_id", path.alias("path")).where(wanted)


@query("""WITH f AS (SELECT conv_id, min(turn) FILTER (WHERE role = 'user' AND turn // 2 < 3) AS asked, min(turn) FILTER (WHERE role = 'assistant' AND turn // 2 < 3) AS answered, max(turn // 2) + 1 AS pages FROM conversations GROUP BY conv_id)
SELECT conv_id, asked, answered, CASE WHEN asked IS NULL OR answered IS NULL THEN least(3, pages) ELSE greatest(asked, answered) // 2 + 1 END AS pages_read, CASE WHEN asked IS NULL OR answered IS NULL THEN 'incomplete' ELSE 'sampled' END AS outcome FROM f""")
def bounded_sample(spark, sf_dir):
    """The first turn of two kinds in the first three pages of two turns; reading stops with the page that has the second."""
    page = F.floor(F.col("turn") / 2)
    first = lambda role: F.min(F.when((F.col("role") == role) & (page < 3), F.col("turn")))
    found = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(first("user").alias("asked"), first("assistant").alias("answered"), (F.max(page) + 1).alias("pages"))
    lacks = F.col("asked").isNull() | F.col("answered").isNull()
    read = F.when(lacks, F.least(F.lit(3), "pages")).otherwise(F.floor(F.greatest("asked", "answered") / 2) + 1)
    return found.select("conv_id", "asked", "answered", read.cast("long").alias("pages_read"), F.when(lacks, "incomplete").otherwise("sampled").alias("outcome"))


@query(r"""WITH g AS (SELECT coalesce(lang, '') AS lang, coalesce(source, '') AS source, count(*) AS n, coalesce(sum(n_chars), 0) AS chars FROM documents GROUP BY 1, 2)
SELECT lang, '| source \| host | documents | characters |' || chr(10) || '| --- | --- | --- |' || chr(10) || string_agg('| ' || source || '\|x | ' || n || ' | ' || chars || ' |', chr(10) ORDER BY source) AS body FROM g GROUP BY lang""")
def index_tables(spark, sf_dir):
    """One Markdown table for each language: a row for each source, bars in cells escaped. The body is the rendered table, as large as it has sources."""
    docs = table(spark, sf_dir, "documents").groupBy(F.coalesce("lang", F.lit("")).alias("lang"), F.coalesce("source", F.lit("")).alias("source"))
    counts = docs.agg(F.count("*").alias("n"), F.coalesce(F.sum("n_chars"), F.lit(0)).alias("chars"))
    cell = lambda c: F.replace(c, F.lit("|"), F.lit("\\|"))
    line = lambda *cells: F.concat(F.lit("| "), F.concat_ws(" | ", *cells), F.lit(" |"))
    rows = F.sort_array(F.collect_list(F.struct("source", "n", "chars")))
    lines = F.transform(rows, lambda r: line(cell(F.concat(r["source"], F.lit("|x"))), r["n"].cast("string"), r["chars"].cast("string")))
    head = F.array(line(cell(F.lit("source | host")), F.lit("documents"), F.lit("characters")), line(*[F.lit("---")] * 3))
    return counts.groupBy("lang").agg(F.array_join(F.concat(head, lines), "\n").alias("body"))


@query("""WITH f AS (SELECT CASE WHEN doc_id % 13 = 0 THEN NULL ELSE doc_id // 3 END AS identity, 'pages/' || repeat('x', CAST(doc_id % 4 AS INTEGER)) || doc_id || '.md' AS path, doc_id % 7 = 0 AS mapped FROM documents),
r AS (SELECT *, row_number() OVER (PARTITION BY identity ORDER BY mapped DESC, length(path) DESC, path DESC) AS k FROM f WHERE identity IS NOT NULL) SELECT identity, path FROM r WHERE k > 1""")
def prunable_files(spark, sf_dir):
    """Files of one identity but the one to keep: the mapped one, else the longest name, else the last."""
    k = F.col("doc_id")
    path = F.concat(F.lit("pages/"), F.expr("repeat('x', CAST(doc_id % 4 AS INT))"), k.cast("string"), F.lit(".md"))
    files = table(spark, sf_dir, "documents").select(F.when(k % 13 != 0, F.floor(k / 3)).alias("identity"), path.alias("path"), (k % 7 == 0).alias("mapped"))
    return ranking_ops.all_but_best(files, "identity", "path", F.struct("mapped", F.length("path"), "path")).select("identity", "path")


@query(r"""SELECT doc_id, CASE doc_id % 6 WHEN 0 THEN '`x`,``y ` z``' WHEN 1 THEN '` `' WHEN 3 THEN '```' || chr(10) || 'code' || chr(10) || '```' WHEN 4 THEN '`even`' ELSE '' END AS spans FROM documents""")
def code_spans(spark, sf_dir):
    """Inline code: runs as wide as each other, escaped and unclosed ones ordinary, none over a blank line."""
    k = F.col("doc_id") % 6
    made = (
        F.when(k == 0, "a `x` b ``y ` z`` c").when(k == 1, "\\`not` `yes").when(k == 2, "`open\n \nclosed`").when(k == 3, "```\ncode\n``` and ``")
        .when(k == 4, "\\\\`even` or \\`odd").otherwise("none `` one `")
    )
    whole = F.concat(made, F.lit("\n\n"), F.translate(F.coalesce("text", F.lit("")), "`", ""))
    return table(spark, sf_dir, "documents").select("doc_id", F.array_join(notes.code_spans(whole), ",").alias("spans"))


@query("""SELECT doc_id, md5(array_to_string(list_transform(string_split(coalesce(text, ''), chr(10)), lambda x, i: CASE (i - 1) % 9 WHEN 0 THEN '# ' || x WHEN 1 THEN x WHEN 2 THEN '- ' || x WHEN 3 THEN '1. ' || x WHEN 4 THEN '> ' || x || chr(10) || '> end'
WHEN 5 THEN '```' || chr(10) || x || chr(10) || '```' WHEN 6 THEN '- [ ] ' || x WHEN 7 THEN '---' ELSE '## ' || x END), chr(10) || chr(10))) AS digest FROM documents""")
def blocks_to_markdown(spark, sf_dir):
    """The lines of each text as blocks of nine kinds, rendered."""
    kinds = F.array(*map(F.lit, ("heading_1", "paragraph", "bulleted", "numbered", "quote", "code", "to_do", "divider", "heading_2")))
    block = lambda x, i: F.struct(F.get(kinds, i % 9).alias("kind"), F.when(i % 9 == 4, F.concat(x, F.lit("\nend"))).otherwise(x).alias("text"))
    blocks = F.transform(F.split(F.coalesce("text", F.lit("")), "\n"), block)
    return table(spark, sf_dir, "documents").select("doc_id", F.md5(notes.markdown_of(blocks)).alias("digest"))


@query("""WITH a AS (SELECT doc_id, source, text, CASE WHEN lang IS NULL THEN 'missing' WHEN lang NOT IN ('en', 'de') THEN 'option_unavailable' ELSE 'written' END AS l, CASE WHEN lang IN ('en', 'de') THEN strlen(lang) ELSE 0 END AS n1 FROM documents),
b AS (SELECT *, CASE WHEN source IS NULL THEN 'missing' ELSE 'written' END AS s, n1 + coalesce(strlen(source), 0) AS n2 FROM a), c AS (SELECT *, CASE WHEN text IS NULL THEN 'missing' WHEN n2 + strlen(text) > 2000 THEN 'budget' ELSE 'written' END AS t,
n2 + CASE WHEN text IS NULL OR n2 + strlen(text) > 2000 THEN 0 ELSE strlen(text) END AS n3 FROM b), d AS (SELECT *, CASE WHEN n3 + strlen('doc-' || doc_id) > 2000 THEN 'budget' ELSE 'written' END AS i FROM c)
SELECT doc_id, 'lang=' || l || ',source=' || s || ',body=' || t || ',ref=' || i AS reasons, CAST(n3 + CASE i WHEN 'written' THEN strlen('doc-' || doc_id) ELSE 0 END AS BIGINT) AS bytes FROM d WHERE doc_id IS NOT NULL""")
def field_projection(spark, sf_dir):
    """Fields that are written within a budget of bytes, and why others are not."""
    fields = [("lang", F.col("lang"), ("en", "de")), ("source", F.col("source"), ()), ("body", F.col("text"), ()), ("ref", F.concat(F.lit("doc-"), F.col("doc_id").cast("string")), ())]
    rows = table(spark, sf_dir, "documents").where("doc_id IS NOT NULL").select("doc_id", notes.projected(fields, 2000).alias("p"))
    return rows.select("doc_id", F.array_join("p.reasons", ",").alias("reasons"), F.col("p.bytes").alias("bytes"))


@query("""WITH RECURSIVE b AS (SELECT l_orderkey AS k, row_number() OVER w AS i, count(*) OVER (PARTITION BY l_orderkey) AS n, l_linenumber % 4 <> 0 AS para, l_returnflag AS color, CAST(l_partkey AS VARCHAR) AS t
FROM lineitem WINDOW w AS (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_returnflag)),
r AS (SELECT k, i, n, para, color, TRUE AS single, 0 AS merged, t AS made, 1 AS size FROM b WHERE i = 1
UNION ALL SELECT k, i, n, para, color, NOT j, merged + CAST(j AS INTEGER), made || CASE WHEN j THEN '+' ELSE '|' END || t, size + CAST(NOT j AS INTEGER)
FROM (SELECT b.k, b.i, b.n, b.para, b.color, b.t, r.merged, r.made, r.size, r.single AND r.para AND b.para AND r.color = b.color AND r.merged < b.n - 3 AND b.n BETWEEN 4 AND 6 AS j FROM r JOIN b ON b.k = r.k AND b.i = r.i + 1))
SELECT k AS l_orderkey, CASE WHEN size <= 3 THEN made ELSE replace(made, '+', '|') END AS blocks, CAST(CASE WHEN size <= 3 THEN merged ELSE 0 END AS BIGINT) AS merged FROM r WHERE i = n""")
def paired_blocks(spark, sf_dir):
    """Neighbouring paragraphs joined in pairs until three blocks are left, or none."""
    block = F.struct("l_linenumber", "l_partkey", "l_returnflag")
    blocks = F.transform(F.sort_array(F.collect_list(block)), lambda x: F.struct(x["l_partkey"].cast("string").alias("text"), (x["l_linenumber"] % 4 != 0).alias("joins"), x["l_returnflag"].alias("color"), F.lit(1).alias("runs")))
    orders = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(blocks.alias("b")).select("l_orderkey", notes.paired(F.col("b"), 3).alias("p"))
    return orders.select("l_orderkey", F.array_join(F.transform("p.blocks", lambda t: F.replace(t, F.lit("\n\n"), F.lit("+"))), "|").alias("blocks"), F.col("p.merged").cast("long").alias("merged"))
