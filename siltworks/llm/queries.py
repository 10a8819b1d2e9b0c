"""Registered queries of the subpackage and the SQL to hold them against."""

from __future__ import annotations

import public_tokenizers

from siltworks.llm import bpe, embedding_dedup, filter_audit, html_extract, minhash, packing, quality, secrets, token_files, topk, url_filter, warc, whitening
from siltworks.llm.shared import table

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def op1_bpe(spark, sf_dir):
    return bpe.round_trip(table(spark, sf_dir, "documents"), TOKENIZER)


def op2_url_filter(spark, sf_dir):
    listed = [(entry, verdict, True) for entry, verdict in RULES] + [(f"{site}.example.{zone}/", "block", False) for site in SPAM_SITES for zone in ZONES]
    return url_filter.judge(table(spark, sf_dir, "pages"), spark.createDataFrame(listed, "entry string, verdict string, given boolean"))


#: The given rules, and the sites in each zone that the block list has (fixed values).
RULES = [("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow")]
SPAM_SITES, ZONES = ["ads-track", "adult-x", "casino-win", "cheap-pills", "free-bets", "spam-farm"], ["com", "net", "org"]


def op3_html(spark, sf_dir):
    return html_extract.extract(table(spark, sf_dir, "pages"))


def op4_quality(spark, sf_dir):
    return quality.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_packing(spark, sf_dir):
    return packing.pack(table(spark, sf_dir, "documents"), TOKENIZER)


def op6_embedding_dedup(spark, sf_dir):
    return embedding_dedup.near_duplicates(table(spark, sf_dir, "embeddings"))


def op7_token_files(spark, sf_dir):
    path = token_files.new_path(spark, "token-files")
    token_files.write_tokens(table(spark, sf_dir, "documents"), TOKENIZER, path)
    return token_files.read_tokens(spark, path, with_ids=False)


def op8_minhash(spark, sf_dir):
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=3, similarity=(85, 100))


def op9_topk(spark, sf_dir):
    return topk.search(table(spark, sf_dir, "embeddings"))


def op10_secrets(spark, sf_dir):
    return secrets.findings(table(spark, sf_dir, "documents"))


def op11_filter_audit(spark, sf_dir):
    return filter_audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op12_whitening(spark, sf_dir):
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


def op13_warc(spark, sf_dir):
    path = token_files.new_path(spark, "archives")
    warc.write_archives(table(spark, sf_dir, "pages"), path)
    return warc.page_captures(spark, path)


OPERATORS = [
    op1_bpe, op2_url_filter, op3_html, op4_quality, op5_packing, op6_embedding_dedup, op7_token_files, op8_minhash, op9_topk, op10_secrets, op11_filter_audit, op12_whitening, op13_warc,
]


def queries():
    return {f.__name__: f for f in OPERATORS}


def oracle_sql():
    return {"op2_url_filter": OP2, "op6_embedding_dedup": embedding_dedup.ORACLE, "op8_minhash": OP8, "op9_topk": topk.ORACLE, "op11_filter_audit": filter_audit.ORACLE, "op13_warc": OP13}


OP2 = """
WITH p AS (SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
b AS (SELECT page_id, coalesce(regexp_extract(rest, '^[^?#]*'), '') AS bare FROM p),
h AS (SELECT page_id, translate(regexp_extract(bare, '^[^/]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
             CASE WHEN instr(bare, '/') > 0 THEN substr(bare, instr(bare, '/')) ELSE '' END AS path FROM b),
s(site) AS (VALUES ('ads-track'), ('adult-x'), ('casino-win'), ('cheap-pills'), ('free-bets'), ('spam-farm')), z(zone) AS (VALUES ('com'), ('net'), ('org')),
r(rule, rhost, rpath, verdict, given) AS (VALUES ('net/', 'net', '/', 'block', true), ('example.net/en/', 'example.net', '/en/', 'allow', true),
  ('example.com/de/', 'example.com', '/de/', 'block', true), ('org/fr/', 'org', '/fr/', 'allow', true)
  UNION ALL SELECT site || '.example.' || zone || '/', site || '.example.' || zone, '/', 'block', false FROM s, z),
m AS (SELECT page_id, host, path, rule, verdict, given, row_number() OVER (PARTITION BY page_id ORDER BY given DESC NULLS LAST, length(rule) DESC NULLS LAST) AS k
      FROM h LEFT JOIN r ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath))
SELECT page_id, host, path, CASE WHEN given THEN rule END AS rule, coalesce(verdict, 'allow') AS verdict, CASE WHEN NOT given THEN rule END AS listed FROM m WHERE k = 1
"""

OP8 = """
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [hash(array_to_string(w, ' '))]
      ELSE list_transform(range(1, len(w) - 1), lambda i: hash(w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) END) AS g FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
l AS (SELECT a.doc_id AS a, b.doc_id AS b FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id JOIN n x ON x.doc_id = a.doc_id JOIN n y ON y.doc_id = b.doc_id
      GROUP BY a.doc_id, b.doc_id, x.n, y.n HAVING 100 * count(*) >= 85 * (x.n + y.n - count(*))),
r AS (SELECT a, b FROM l UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a),
c AS (SELECT a, min(b) AS m FROM r GROUP BY a)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, least(d.doc_id, coalesce(c.m, d.doc_id)) AS component_id, least(d.doc_id, coalesce(c.m, d.doc_id)) = d.doc_id AS kept
FROM documents d LEFT JOIN n USING (doc_id) LEFT JOIN c ON c.a = d.doc_id
"""

OP13 = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h, sha1(coalesce(html, '')) AS s, url FROM pages),
g AS (SELECT page_id, url, h, s, max(page_id) OVER (PARTITION BY h) AS top FROM p),
i AS (SELECT *, coalesce(top <> coalesce(page_id, top - 1), false) AS again,
  list_transform(range(32), lambda k: (('0x' || s[k * 5 // 4 + 1])::BIGINT * 16 + ('0x' || coalesce(nullif(s[k * 5 // 4 + 2], ''), '0'))::BIGINT) >> (3 - k * 5 % 4) & 31) AS d FROM g)
SELECT page_id, strlen(h) AS payload_bytes, array_to_string(list_transform(d, lambda v: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', v + 1, 1)), '') AS payload_digest,
  CASE WHEN again THEN 'revisit' ELSE 'response' END AS record_type, CASE WHEN again THEN top END AS refers_to, coalesce(nullif(url, ''), 'about:blank') AS target_uri FROM i
"""
