"""Filter audit, whitening and web archives against plain versions."""

import base64
import gzip
import hashlib
import itertools
import math
import random
import re
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from siltworks.llm import filter_audit, token_files, warc, whitening

CLASHES = ("n", "fails", "digest", "kept", "part", "marks", "first", "vector", "width", "type", "of", "__hot", "refers", "id0", "label")

# -- 11 -----------------------------------------------------------------------------------------

LONG = " ".join(f"w{i}" for i in range(60))
AUDITED = [
    (1, LONG, "a"), (2, LONG, "a"), (3, LONG + " #", "a"), (4, "same " * 80, "b"), (5, "", "b"), (6, None, "b"), (7, " \n\t ", None), (8, "A" * 30 + "x" * 400, ""), (9, "é" * 99 + "AAAAA", "c"),
    (10, "é" * 95 + "AAAAA", "c"), (11, "a|b " * 60000, "c"), (None, LONG, "a"), (None, "", None), (12, LONG, "a"), (12, LONG, "a"), (13, "A\x1cb \x0b c d", "c"),
]


def audited_by_hand(rows, labels):
    good, toxic = ({d for d, *v in labels if d is not None and v[i] == 1} for i in (0, 1))
    first = {}
    for d, t, _ in rows:
        if d is not None:
            first[t or ""] = min(first.get(t or "", d), d)
    judged = []
    for d, t, s in rows:
        t = t or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        fails = set()
        if len(w) < 50:
            fails.add("A")
        if 100 * len(set(w)) < 65 * len(w):
            fails.add("B")
        if 100 * len(re.findall("[A-Z]", t)) > 5 * len(t):
            fails.add("C")
        if re.search(r"[#$%&*|]", t):
            fails.add("D")
        if d is not None and first[t] < d:
            fails.add("E")
        judged.append((s or "", fails, d in good, d in toxic))
    out, shapley = {}, Counter()
    for order in itertools.permutations("ABCDE"):
        for part in {j[0] for j in judged}:
            left = [j for j in judged if j[0] == part]
            failing = Counter(f for j in left for f in j[1])
            alone = Counter(f for j in left if len(j[1]) == 1 for f in j[1])
            for step, f in enumerate(order, 1):
                gone, left = [j for j in left if f in j[1]], [j for j in left if f not in j[1]]
                shapley[part, f] += len(gone)
                out[part, "".join(order), step] = [len(left), len(gone), failing[f] - len(gone), alone[f], sum(j[2] for j in gone), sum(j[3] for j in gone)]
    return {(p, o, s): tuple(v) + (shapley[p, o[s - 1]],) for (p, o, s), v in out.items()}


def test_audit_against_counting_by_hand(spark):
    labels = [(1, 1, 0), (2, 1, 1), (3, None, 1), (4, 0, 0), (11, 1, None), (12, 0, 0), (12, 1, 0), (None, 1, 1), (99, 1, 1)]
    docs = spark.createDataFrame(AUDITED, "doc_id long, text string, source string").withColumns({c: F.lit("clash") for c in CLASHES})
    got = filter_audit.audit(docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int").withColumn("fails", F.lit(1))).collect()
    found = {(r.part, r.filter_order, r.step): (r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.toxic_lost, r.shapley) for r in got}
    assert len(got) == len(found) and found == audited_by_hand(AUDITED, labels)


def test_audit_of_an_empty_table(spark):
    assert filter_audit.audit(spark.createDataFrame([], "doc_id long, text string, source string"), spark.createDataFrame([], "doc_id long, quality int, toxic int")).count() == 0


def test_survivors_of_random_rows():
    pick = np.random.default_rng(3)
    n, k = 5000, 6
    codes, fails, marks = np.unique(pick.integers(0, 300, n) ** 2 // 400, return_inverse=True)[1], pick.integers(0, 1 << k, n), pick.integers(0, 4, n)
    got = filter_audit.survivors(codes, fails, marks, k, 2)
    for subset in (0, 5, 33, (1 << k) - 1):
        passing = (fails & subset) == 0
        for j, kind in enumerate((passing, passing & (marks & 1 > 0), passing & (marks & 2 > 0))):
            assert got[subset, :, j].tolist() == np.bincount(codes[kind], minlength=codes.max() + 1).tolist()


# -- 12 -----------------------------------------------------------------------------------------


def whitened_rows(spark, rows, kind="float", **options):
    table = spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>").withColumns({c: F.lit("clash") for c in CLASHES if c not in ("n",)})
    return whitening.whiten(table, **options).collect()


def exact_parts(vectors, scale=64, shift=1_000_000):
    x = [[math.floor(Fraction(c) * scale) + shift for c in v] for v in vectors]
    n, d = len(x), len(x[0])
    sums = [sum(r[i] for r in x) for i in range(d)]
    y = [[n * r[i] - sums[i] for i in range(d)] for r in x]
    return n, y, [[Fraction(sum(r[i] * r[j] for r in y), n**3) for j in range(d)] for i in range(d)]


@pytest.mark.parametrize("size", [1.0, 1e3])
def test_whitening_against_fractions(spark, size):
    pick = np.random.default_rng(7)
    vectors = (pick.normal(size=(300, 12)) @ pick.normal(size=(12, 12)) * size).astype(np.float32).astype(float).tolist()
    odd = [(900, None), (901, []), (902, [float("nan")] * 12), (903, [1.0] * 11 + [None]), (904, [float("inf")] * 12), (905, [1.0, 2.0])]
    got = whitened_rows(spark, list(enumerate(vectors)) + odd + [(None, vectors[0]), (3, vectors[3])])
    used = vectors + [vectors[0], vectors[3]]
    n, y, v = exact_parts(used)
    values, vectors_of = np.linalg.eigh(np.array(v, float))
    values, vectors_of = values[::-1], vectors_of[:, ::-1]
    assert len(got) == 302 * 12 and {r.n for r in got} == {302}
    by_row = defaultdict(dict)
    for r in got:
        by_row[r.vec_id, r.deviation][r.component] = r
    want = Counter((i, sum(c * c for c in row)) for i, row in zip([*range(300), None, 3], y, strict=True))
    assert set(by_row) == set(want)
    for (i, _), parts in by_row.items():
        row = y[300 if i is None else i]
        exact = np.array(row, float) / n @ vectors_of / np.sqrt(values)
        assert np.allclose([abs(parts[k + 1].whitened) for k in range(12)], abs(exact), rtol=1e-7, atol=1e-9)
    trace = float(sum(v[i][i] for i in range(12)))
    assert all(abs(r.explained - values[r.component - 1] / trace) <= 1e-9 for r in got) and max(r.identity_error for r in got) < 1e-9
    one_sign = [[by_row[(3, sum(c * c for c in y[3]))][k].whitened, by_row[(5, sum(c * c for c in y[5]))][k].whitened] for k in range(1, 13)]
    exact = [[np.dot(np.array(y[i], float) / n, vectors_of[:, k]) / math.sqrt(values[k]) for i in (3, 5)] for k in range(12)]
    assert all(a[0] * a[1] * b[0] * b[1] > 0 for a, b in zip(one_sign, exact, strict=True))


def test_whitening_of_uneven_and_flat_dimensions(spark):
    """One dimension a million times the others, one constant: 1e-12 of the trace still whitens."""
    pick = np.random.default_rng(1)
    vectors = np.column_stack([pick.normal(size=200) * 1e7, pick.normal(size=200) * 10, np.full(200, 3.0), pick.normal(size=200) * 10])
    got = whitened_rows(spark, list(enumerate(vectors.tolist())), "double")
    assert max(r.identity_error for r in got) < 1e-4
    assert {r.component for r in got if r.whitened is None} == {4} and {r.explained for r in got if r.component == 4} == {0.0}
    _, _, v = exact_parts(vectors.tolist())
    small = np.linalg.eigvalsh(np.array([[float(v[i][j] - v[i][0] * v[0][j] / v[0][0]) for j in (1, 3)] for i in (1, 3)]))[::-1] / float(sum(v[i][i] for i in range(4)))
    assert np.allclose(sorted({r.explained for r in got if r.component in (2, 3)}, reverse=True), small, rtol=1e-6)


def test_products_are_exact():
    pick = random.Random(2)
    for top in (5, 1 << 20, 1 << 45, 1 << 90):
        y = np.array([[pick.randint(-top, top) for _ in range(5)] for _ in range(50)], object)
        y = y if top > 1 << 60 else y.astype(np.int64)
        plain = [[sum(int(r[i]) * int(r[j]) for r in y) for j in range(5)] for i in range(5)]
        assert whitening.product(y).tolist() == plain
        assert all(sum(d << whitening.DIGIT * k for k, d in whitening.digits(v)) == v for row in plain for v in row)
    assert whitening.product(np.full((whitening.ROWS, 2), -(1 << 62), np.int64)).tolist() == [[whitening.ROWS << 124] * 2] * 2


def test_whitening_edges(spark):
    assert whitened_rows(spark, []) == [] and whitened_rows(spark, [(1, None)]) == []
    one = whitened_rows(spark, [(1, [1.0, 2.0])])
    assert [(r.component, r.deviation, r.whitened, r.explained, r.identity_error) for r in one] == [(1, 0, None, 0.0, 0.0), (2, 0, None, 0.0, 0.0)]
    huge = whitened_rows(spark, [(1, [1e300, 1.0]), (2, [-1e300, 1.0])], "double")
    assert {r.deviation for r in huge} == {None} and sorted(r.whitened for r in huge if r.component == 1) == [-1.0, 1.0]
    wide = whitened_rows(spark, [(i, np.random.default_rng(i).normal(size=40).tolist()) for i in range(100)])
    assert {r.component for r in wide} == set(range(1, 33))


# -- 13 -----------------------------------------------------------------------------------------

PAGES = [
    (1, "http://a.example/x y\r\nWARC-Type: evil", "<p>one</p>"), (2, "http://a.example/?q#f", "<p>one</p>"), (3, None, "<p>one</p>"), (4, "", ""), (5, "http://b.example", None), (6, "no scheme", "tail\r\n\r\n"),
    (7, "u", "x\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\n\r\n"), (8, "http://é.example/ü", "日本語 😀\u0000\x85"), (None, "u", "<p>one</p>"), (None, "n", "alone"), (None, "m", "alone"), (9, "t", "tied"), (9, "t", "tied"),
    (9, "s", "tied"), (2, "w", "tied"), (10, "big", "0123456789" * 3_000_000),
]


def digest_of(html):
    return base64.b32encode(hashlib.sha1((html or "").encode()).digest()).decode()


def test_archives_round_trip(spark):
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string").withColumns({c: F.lit("clash") for c in CLASHES})
    path = token_files.new_path(spark, "warc-test")
    warc.write_archives(pages, path)
    top = {}
    for i, _, h in PAGES:
        top[h or ""] = max(top.get(h or "", -1), -1 if i is None else i)
    want = Counter()
    for i, _, h in PAGES:
        again = top[h or ""] >= 0 and i != top[h or ""]
        want[i, len((h or "").encode()), digest_of(h), "revisit" if again else "response", top[h or ""] if again else None] += 1
    got = Counter((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in warc.page_captures(spark, path).collect())
    assert got == want
    records = warc.read_records(spark, path)
    stored = Counter(bytes(r.payload) for r in records.where("type = 'response'").collect())
    assert stored == Counter((h or "").encode() for i, _, h in PAGES if not (top[h or ""] >= 0 and i != top[h or ""]))
    nested = warc.captures(records).collect()
    assert len(nested) == len(PAGES) and all(r.n_requests >= 1 and r.n_metadata >= 1 and r.request.type == "request" for r in nested)
    assert all(r.request.record_id != r.response.record_id and r.response.record_id in r.request.concurrent_to for r in nested)
    # any gzip reader sees plain WARC in the files
    raw = b"".join(gzip.decompress(bytes(r.content)) for r in spark.read.format("binaryFile").load(path).collect())
    assert raw.count(b"WARC/1.1\r\nWARC-Type: re") == 2 * len(PAGES) + 1 and raw.endswith(b"\r\n\r\n")


def test_archives_from_a_size_on(spark):
    rows = [(1, "a", "short"), (2, "b", "short"), (3, "c", "longer text"), (4, "d", "longer text"), (5, "e", "longer text")]
    path = token_files.new_path(spark, "warc-test")
    warc.write_archives(spark.createDataFrame(rows, "page_id long, url string, html string"), path, repeats_from=6)
    assert {r.page_id: r.refers_to for r in warc.page_captures(spark, path).collect()} == {1: None, 2: None, 3: 5, 4: 5, 5: None}


def test_no_pages(spark):
    path = token_files.new_path(spark, "warc-test")
    warc.write_archives(spark.createDataFrame([], "page_id long, url string, html string"), path)
    assert warc.page_captures(spark, path).count() == 0 and warc.read_records(spark, path).count() == 0


def made(kind, name, block=b"", **more):
    return warc.record([("WARC-Type", kind), ("WARC-Record-ID", f"<{name}>"), *((k.replace("_", "-"), v) for k, v in more.items())], block)


def test_foreign_archives(spark, tmp_path):
    """Plain files, folded headers, links in either direction and in chains, loose records, damage."""
    http = b"HTTP/1.1 200 OK\r\nX: y\r\n\r\nbody"
    good = made("warcinfo", "i") + made("response", "r", http, Content_Type="application/http; msgtype=response", WARC_Concurrent_To="<q>") + made("request", "q", b"GET", Content_Type="text/plain")
    good += made("metadata", "m1", b"a: 1\r\n b\r\nc:2", WARC_Concurrent_To="<q>", Content_Type="application/warc-fields") + made("metadata", "m2", WARC_Concurrent_To="<r>") + made("request", "loose")
    (tmp_path / "a.warc").write_bytes(good)
    (tmp_path / "b.warc.gz").write_bytes(gzip.compress(made("resource", "s", b"data")) + gzip.compress(made("metadata", "t", WARC_Concurrent_To="<s>"))[:-9])
    (tmp_path / "c.warc").write_bytes(made("resource", "u", b"data")[:-2])
    (tmp_path / "d.warc").write_bytes(b"not an archive\r\n\r\n")
    (tmp_path / "e.warc").write_bytes(b"")
    records = warc.read_records(spark, str(tmp_path))
    assert Counter(r.problem for r in records.where("problem is not null").collect()) == {"a gzip member is cut off": 1, "a record is cut off": 1, "no record starts here": 1}
    found = {(r.response or r.request).record_id: r for r in warc.captures(records).collect()}
    assert set(found) == {"<r>", "<s>", "<loose>"}
    r = found["<r>"]
    assert (bytes(r.response.payload), r.response.payload_digest, r.request.record_id, r.metadata.record_id, r.n_metadata) == (b"body", digest_of("body"), "<q>", "<m1>", 2)
    assert r.metadata.fields == {"a": "1 b", "c": "2"} and found["<loose>"].response is None


def test_looked_up_keeps_hot_rows(spark):
    rows = spark.range(5000).select(F.col("id"), F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") < 4000, F.concat(F.lit("k"), F.col("id").cast("string"))).alias("key"))
    groups = rows.where("key is not null").groupBy("key").agg(F.max("id").alias("v"), F.count("*").alias("n"))
    got = {r.id: r.v for r in warc.looked_up(rows, "key", groups, "v").collect()}
    assert got == {i: 4998 if i % 3 == 0 else i if i < 4000 else None for i in range(5000)}
