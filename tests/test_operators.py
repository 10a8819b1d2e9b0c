"""Properties of operators on small tables, nulls and ties included."""

import json
import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from siltworks.functions import dates, hashing, notes, numbers, text
from siltworks.operators import changes, joining, merging, ranking
from siltworks.sources import paged
from siltworks.sources.state import CommitConflict, StateTable, recover_intents
from siltworks.streaming import incremental


def values(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


def test_diff_and_upsert(spark):
    a = spark.createDataFrame([(1, "x"), (2, None), (3, "z")], "k int, v string")
    b = spark.createDataFrame([(2, None), (3, "y"), (4, "w")], "k int, v string")
    assert values(changes.snapshot_diff(a, b, "k", "v"), "k", "change") == [(1, "removed"), (2, "unchanged"), (3, "changed"), (4, "added")]
    assert [r[0] for r in sorted(changes.upsert(a, b, ["k"]).select("k").collect())] == [1, 2, 3, 4]
    assert values(changes.changed_only(a, b, ["k"], "v"), "k") == [(3,), (4,)]
    assert values(changes.classify_scan(b, a, "k", "v", first_scan=True), "outcome") == [("baseline",)] * 3
    assert values(changes.retained(a, b, "k"), "k") == [(1,)]


def test_version_tells_null_from_empty(spark):
    df = spark.createDataFrame([(None,), ("",)], "v string").select(changes.version_of("v").alias("h"))
    assert df.distinct().count() == 2


def test_fingerprint_ignores_order(spark):
    df = spark.createDataFrame([(i, str(i)) for i in range(50)], "a int, b string")
    one = changes.tree_fingerprint(df, "a", "b").first()
    assert one == changes.tree_fingerprint(df.orderBy(F.desc("a")).repartition(3), "a", "b").first()


def test_fair_order_takes_keys_in_turn(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("a", 3), ("b", 4), ("c", 5)], "k string, seq int")
    order = ranking.fair_order(df, "k", "seq", 9, cursor=1).orderBy("position")
    assert [(r.k, r.seq) for r in order.collect()] == [("b", 4), ("c", 5), ("a", 1), ("a", 2), ("a", 3)]
    assert [r.seq for r in ranking.fair_order(df, "k", "seq", 2).orderBy("position").collect()] == [1, 4]


def test_rotation_reaches_every_id(spark):
    df = spark.range(7).withColumnRenamed("id", "k")
    cursor, seen = -1, set()
    for _ in range(4):
        page = [r.k for r in ranking.after_cursor(df, "k", cursor, 2).collect()]
        seen.update(page)
        cursor = page[-1]
    assert seen == set(range(7))


def test_streak_breaks_on_a_missing_period(spark):
    df = spark.createDataFrame([("s", p, ok) for p, ok in [(1, True), (2, True), (4, True), (5, True), (6, False), (7, True)]], "g string, p long, ok boolean")
    assert tuple(ranking.streaks(df, "g", "p", "ok").first()) == ("s", 2, 2, 1)


def test_ties_and_change_points(spark):
    df = spark.createDataFrame([("g", 1, "a"), ("g", 2, "a"), ("g", 3, None), ("g", 4, None), ("g", 5, "b")], "g string, i int, v string")
    assert values(ranking.change_points(df, "g", "i", "v"), "i") == [(1,), (3,), (5,)]
    assert ranking.with_ties(df, ["g"], F.col("g")).count() == 5


def test_cardinality_rule(spark):
    left = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c"), (4, None)], "id int, k string")
    right = spark.createDataFrame([("a", 10), ("b", 20), ("b", 21)], "k string, t int")
    assert [(r.id, r.t, r.outcome) for r in joining.link_if_unique(left, right, "k", "t").orderBy("id").collect()] == [(1, 10, "linked"), (2, None, "ambiguous"), (3, None, "missing"), (4, None, "missing")]


def test_asof_takes_the_nearest_day(spark):
    left = spark.sql("select 1 id, date'2024-01-10' day union all select 2, date'2024-02-10'")
    right = spark.sql("select date'2024-01-04' day, 1 s union all select date'2024-01-09', 2 union all select date'2024-01-09', 3 union all select date'2024-01-11', 4")
    assert [(r.id, r.s, r.age) for r in joining.asof_prior(left, right, "day", 7, F.desc("s")).orderBy("id").collect()] == [(1, 3, 1), (2, None, None)]


def test_runs_inside_arrays(spark):
    row = spark.sql("select array(1,2,1,2,1) a, array(1,2) b, array(9) c, cast(array() as array<int>) d")
    assert tuple(row.select(joining.contains_run(F.col("a"), F.col("b")), joining.contains_run(F.col("c"), F.col("b")), joining.contains_run(F.col("a"), F.col("d"))).first()) == (2, 0, 0)


@pytest.mark.parametrize(
    ("desired", "current", "managed", "what"),
    [("a", "a", "a", "keep"), ("a", "a", "b", "adopt"), ("a", "b", "b", "write"), ("a", "b", "c", "hold"), ("a", None, None, "write"), ("a", "", "c", "hold"), (None, None, None, "keep")],
)
def test_three_way(spark, desired, current, managed, what):
    row = spark.createDataFrame([(desired, current, managed)], "d string, c string, m string")
    assert row.select(merging.three_way(F.col("d"), F.col("c"), F.col("m"))).first()[0] == what


def test_batches_and_runs(spark):
    row = spark.createDataFrame([([5, 5, 5, 100, 1],)], "w array<bigint>")
    assert row.select(merging.batches(F.col("w"), 2, 12)).first()[0] == [0, 0, 1, 2, 3]
    runs = spark.sql("select array(named_struct('kind','a','text','x'), named_struct('kind','a','text','y'), named_struct('kind','b','text','z')) r")
    assert [tuple(x) for x in runs.select(merging.merge_runs(F.col("r"))).first()[0]] == [("a", "xy"), ("b", "z")]


def test_stamps(spark):
    cases = ["2024-01-15T10:00:00", "2024-01-15T10:00:00Z", "1705312800", "1705312800000", "2024-01-15", "nonsense", "", None, "2024-13-45T00:00:00Z"]
    df = spark.createDataFrame([(i, c) for i, c in enumerate(cases)], "i int, s string")
    got = [r[0] for r in df.orderBy("i").select(F.date_format(dates.parse_time(F.col("s")), "MM-dd HH:mm")).collect()]
    assert got == ["01-15 02:00", "01-15 10:00", "01-15 10:00", "01-15 10:00", "01-14 16:00", None, None, None, None]


def test_freshness_limit_is_inclusive(spark):
    row = spark.sql("select timestamp'2024-01-01 00:00:00' a, timestamp'2024-01-02 00:00:00' n")
    at = lambda limit: row.select(dates.freshness(F.col("a"), F.col("n"), F.lit(limit))).first()[0]
    assert (at(24.0), at(23.9), at(0.0)) == ("fresh", "stale", "invalid_limit")


def test_text_pieces():
    mixed = "a😀" * 1500
    parts = list(text.utf16_chunks(mixed, 2000))
    assert "".join(parts) == mixed and max(len(p.encode("utf-16-le")) // 2 for p in parts) <= 2000
    prose = ("word " * 50 + "\n") * 40
    soft = list(text.soft_chunks(prose))
    assert "".join(soft) == prose and max(map(len, soft)) <= 1800


def test_pieces_go_on_before_a_batch_is_split(spark):
    """Pieces of a batch are not all held at once: the splitter is at most ``GATHERED`` characters ahead of what went on."""

    class Frame:
        schema = spark.createDataFrame([], "k long, t string").schema

        def select(self, *names):
            return self

        def mapInArrow(self, run, schema):  # noqa: N802
            return run

    run, given = text.split_rows(Frame(), "k", "t", lambda t: (given.append(len(t)), iter([t]))[1]), []
    batch = pa.RecordBatch.from_arrays([pa.array(range(40)), pa.array(["x" * (text.GATHERED // 4)] * 38 + [None, ""])], ["k", "t"])
    ahead, rows = 0, []
    for part in run(iter([batch])):
        rows += part.to_pylist()
        ahead = max(ahead, part.num_rows)
        assert len(given) == len(rows)
    assert ahead == 4 and [r["k"] for r in rows] == list(range(38))


def test_batches_of_long_lists(spark):
    """Every batch against a plain loop; 150,000 items in seconds, which copying the numbers for each item does not reach."""
    from time import monotonic

    def plain(sizes):
        out, n, total = [], 0, 0
        for s in sizes:
            if not out or n + 1 > 100 or total + s > 300:
                out, n, total = [*out, (out[-1] + 1) if out else 0], 0, 0
            else:
                out = [*out, out[-1]]
            n, total = n + 1, total + s
        return out

    pick = random.Random(3)
    cases = [[], [500], [1] * 250, [500, 500, 1], *([pick.choice([0, 1, 7, 90, 301]) for _ in range(pick.randrange(300))] for _ in range(20))]
    rows = spark.createDataFrame(list(enumerate(cases)), "i int, s array<long>").withColumn("x", F.transform("s", lambda v: F.array(F.lit(1).cast("long"), v)))
    assert {r.i: r.b for r in rows.select("i", merging.batches_within(F.col("x"), [100, 300]).alias("b")).collect()} == {i: plain(c) for i, c in enumerate(cases)}
    started = monotonic()
    long = spark.range(1).select(F.transform(F.sequence(F.lit(1), F.lit(150_000)), lambda v: F.array(F.lit(1).cast("long"), F.lit(5).cast("long"))).alias("x"))
    got = long.select(merging.batches_within(F.col("x"), [100, 300]).alias("b")).select(F.size("b"), F.array_max("b")).first()
    assert tuple(got) == (150_000, 2499) and monotonic() - started < 10


def test_first_line_keeps_digits_and_drops_blanks(spark):
    cases = ["0 call 555-8630\nx", "\n 1 of 1 \n2", " \u3000\n\u00a0 22 a2\u2003\n", "  both  ", "tab\t \r", "\u200b", " \n ", "", None, "é" * 5 + " 0123456"]
    df = spark.createDataFrame([(i, c) for i, c in enumerate(cases)], "i int, s string").orderBy("i")
    got = [r[0] for r in df.select(text.first_line(F.col("s"), 15)).collect()]
    assert got == ["0 call 555-8630", "1 of 1", "22 a2", "both", "tab\t \r", "\u200b", "", "", "", "é" * 5 + " 0123456"]


def test_truncate_utf8(spark):
    cases = ["short", "é" * 10, "日本語テキスト", "a" * 9 + "😀", "", None]
    df = spark.createDataFrame([(i, c) for i, c in enumerate(cases)], "i int, s string").orderBy("i")
    got = [r[0] for r in df.select(text.truncate_utf8(F.col("s"), 10)).collect()]
    assert got == ["short", "é" * 5, "日本語", "a" * 9, "", None]


def test_front_matter(spark):
    row = spark.createDataFrame([("---\na: 1\nb: x: y\na: 2\n---\nbody",), ("no head",), (None,)], "t string")
    got = [r[0] for r in row.select(text.front_matter(F.col("t"))).collect()]
    assert got[0] == {"a": "2", "b": "x: y"} and not got[1] and not got[2]


def test_hashes(spark):
    import hashlib
    import hmac

    row = spark.createDataFrame([("héllo",)], "s string")
    assert row.select(hashing.hmac_sha256(b"key", F.col("s"))).first()[0] == hmac.new(b"key", "héllo".encode(), hashlib.sha256).hexdigest()
    raw = "héllo".encode()
    assert row.select(hashing.blob_sha1(F.col("s"))).first()[0] == hashlib.sha1(b"blob %d\0" % len(raw) + raw).hexdigest()
    assert row.select(numbers.format_seconds(F.lit(3723))).first()[0] == "1h 2m 3s"


def page(cursor, following, rows):
    return {"cursor": cursor, "next": following, "has_more": following is not None, "rows": rows}


def test_pages(spark, tmp_path):
    good = "\n".join(map(json.dumps, [page(None, "c1", [{"id": "1"}, {"id": "2"}]), page("c1", None, [{"id": "3"}])]))
    (tmp_path / "a.txt").write_text(good)
    df = paged.read_pages(spark, str(tmp_path), "id string, body string")
    assert values(df, "id") == [("1",), ("2",), ("3",)]
    assert paged.check_pages(df).count() == 3
    with pytest.raises(Exception, match="twice"):
        paged.check_pages(df.union(df)).collect()


def test_chains_with_each_fault(spark):
    row = lambda *ids: [(i,) for i in ids]
    chains = {
        "complete": [(0, None, "a", True, 3, 5, row("1", "2")), (1, "a", None, False, 3, 5, row("3"))], "shape": [(0, None, None, None, None, 1, row("1"))], "cursor": [(0, None, "a", True, None, 1, row("1")), (1, "b", None, False, None, 1, row("2"))],
        "repeated_cursor": [(0, None, "a", True, None, 1, row("1")), (1, "a", "a", True, None, 1, row("2")), (2, "a", None, False, None, 1, row("3"))], "empty_page": [(0, None, "a", True, None, 1, []), (1, "a", None, False, None, 1, row("1"))],
        "end": [(0, None, "a", False, None, 1, row("1"))], "after_last": [(0, None, None, False, None, 1, row("1")), (1, None, None, False, None, 1, row("2"))], "missing_last": [(0, None, "a", True, None, 1, row("1"))],
        "repeated_id": [(0, None, "a", True, None, 1, row("1")), (1, "a", None, False, None, 1, row("1"))], "total": [(0, None, None, False, 2, 1, row("1"))], "bytes": [(0, None, "a", True, None, 50, row("1")), (1, "a", None, False, None, 60, row("2"))],
        "cursor ": [(0, None, "a", True, None, 1, row("1")), (2, "a", None, False, None, 1, row("2"))],
    }
    pages = spark.createDataFrame([(k, *p) for k, v in chains.items() for p in v], "chain string, place int, cursor string, next string, has_more boolean, total long, bytes long, rows array<struct<id:string>>")
    assert {r.chain: r.outcome for r in paged.chain_outcomes(pages, most_bytes=100).collect()} == {k: k.strip() for k in chains}
    rows, held = paged.whole_chains(pages, most_bytes=100)
    assert sorted(r.id for r in rows.collect()) == ["1", "2", "3"] and held.count() == len(chains) - 1


def test_chains_that_end_without_news(spark):
    pages = [("a", 0, ["1", "2"]), ("a", 1, ["2", "3"]), ("a", 2, ["3", "1"]), ("a", 3, ["4"]), ("b", 0, ["1"]), ("b", 1, [])]
    df = spark.createDataFrame([(c, p, [(i,) for i in ids]) for c, p, ids in pages], "chain string, place int, rows array<struct<id:string>>")
    assert sorted(tuple(r) for r in paged.until_nothing_new(df).collect()) == [("a", "1", 0), ("a", "2", 0), ("a", "3", 1), ("b", "1", 0)]


@pytest.mark.parametrize(
    "pages",
    [
        [page(None, "c1", [{"id": "1"}])],
        [page(None, "c1", []), page("c1", None, [])],
        [page(None, "c1", [{"id": "1"}]), page("c2", None, [])],
        [page(None, "c1", [{"id": "1"}]), page("c1", "c1", [{"id": "2"}]), page("c1", None, [])],
        [{"rows": []}],
        [page(None, None, []), page(None, None, [])],
    ],
)
def test_broken_pages_stop_the_scan(pages):
    with pytest.raises(paged.ScanError):
        list(paged.chain(iter(pages)))


def test_page_numbers(spark):
    got = paged.pages_of(spark.range(95).toDF("k"), "k", 20).groupBy("page").count().orderBy("page").collect()
    assert [tuple(r) for r in got] == [(0, 20), (1, 20), (2, 20), (3, 20), (4, 15)]


def test_state_commits_once(spark, tmp_path):
    state = StateTable(spark, f"file://{tmp_path}/s", "k long, v string", ["k"])
    assert state.read().count() == 0
    rows = spark.createDataFrame([(1, "a"), (2, "b")], "k long, v string")
    assert state.upsert(rows) == 1 and state.upsert(rows) == 1
    assert state.upsert(rows.where("k = 1").withColumn("v", F.lit("c"))) == 2
    assert values(state.read(), "k", "v") == [(1, "c"), (2, "b")] and values(state.read(1), "k", "v") == [(1, "a"), (2, "b")]
    with pytest.raises(CommitConflict):
        state.commit(rows, 1)
    assert state.delete(rows.where("k = 2")) == 3


def test_intents(spark):
    intents = spark.createDataFrame([(1, "n", "o"), (2, "n", "o"), (3, "n", "o"), (4, "n", "o")], "k int, version string, before string")
    seen = spark.createDataFrame([(1, "n"), (2, "o"), (3, "x")], "k int, version string")
    assert values(recover_intents(intents, seen, "k"), "k", "outcome") == [(1, "verified"), (2, "retry"), (3, "held"), (4, "retry")]


def test_stream_restarts(spark, tmp_path):
    schema = "k long, seq long, v string"
    state = StateTable(spark, f"file://{tmp_path}/s", schema, ["k"])
    run = lambda: incremental.run_available(spark, f"file://{tmp_path}/in", schema, state, "k", ["seq"], f"file://{tmp_path}/c")
    write = lambda rows: spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"file://{tmp_path}/in")
    write([(1, 1, "a"), (2, 2, "b")])
    run()
    write([(1, 3, "c"), (2, 1, "late")])
    run()
    version = state.version()
    run()
    assert state.version() == version and values(state.read(), "k", "v") == [(1, "c"), (2, "b")]


def test_watermark_freezes_on_a_partial_scan(spark):
    last, scan = spark.createDataFrame([(5,)], "watermark int"), spark.createDataFrame([(9,), (None,)], "t int")
    assert incremental.advance_watermark(last, scan, "t", complete=True).first()[0] == 9
    assert incremental.advance_watermark(last, scan, "t", complete=False).first()[0] == 5


def test_paired_blocks(spark):
    rows = [
        (1, [("a", True, "x", 1), ("b", True, "x", 1), ("c", True, "x", 1)]),
        (2, [("a", True, "x", 1), ("b", False, "x", 1), ("c", True, "x", 1)]),
        (3, [("a", True, "x", 1), ("b", True, None, 1), ("c", True, None, 1)]),
        (4, [("a", True, "x", 1), ("b", True, "x", 3), ("c", True, "x", 1)]),
        (5, [("a", True, "x", 1)]),
        (6, []),
        (7, None),
    ]
    df = spark.createDataFrame(rows, "k int, b array<struct<text:string,joins:boolean,color:string,runs:int>>")
    got = {r["k"]: (r["blocks"], r["merged"]) for r in df.select("k", notes.paired(F.col("b"), 2, 4).alias("p")).select("k", "p.*").collect()}
    assert got[1] == (["a\n\nb", "c"], 1) and got[2] == (["a", "b", "c"], 0) and got[3] == (["a", "b\n\nc"], 1)
    assert got[4] == (["a", "b", "c"], 0) and got[5] == (["a"], 0) and got[6] == ([], 0) and got[7][0] is None


def test_code_spans_of_long_texts(spark):
    long = "`" + "x \n" * 50_000 + "y`"
    rows = [(1, long), (2, "``a`b`` `c"), (3, ""), (4, None), (5, "\\\\\\`a` b`"), (6, "`a`\\\\`b`")]
    got = dict(spark.createDataFrame(rows, "k int, t string").select("k", notes.code_spans(F.col("t"))).collect())
    assert got == {1: [long], 2: ["``a`b``"], 3: [], 4: None, 5: ["` b`"], 6: ["`a`", "`b`"]}


def test_meta_and_globs(spark):
    rows = [("<META CONTENT=\"it's\" name='Description'><meta name=description2 content=no>",), ("<p>none</p>",), ("",), (None,)]
    html = spark.createDataFrame(rows, "h string")
    assert [r[0] for r in html.select(notes.meta_content(F.col("h"), "name", "description")).collect()] == ["it's", "", "", ""]
    paths = spark.createDataFrame([("a.md",), ("x/y/a.md",), ("x/a.mdx",), ("x/+.md",), (None,)], "p string")
    got = paths.select(notes.tracked(F.col("p"), ("**/*.md",), ("x/+.md",))).collect()
    assert [r[0] for r in got] == [True, True, False, False, None]


def test_projected_fields(spark):
    df = spark.createDataFrame([("en", "abc", "xyz"), (None, "abcdef", "é"), ("fr", None, None)], "a string, b string, c string")
    got = df.select(notes.projected([("a", F.col("a"), ("en",)), ("b", F.col("b"), ()), ("c", F.col("c"), ())], 5).alias("p")).select("p.*").collect()
    assert [tuple(r) for r in got] == [(["a=written", "b=written", "c=budget"], 5), (["a=missing", "b=budget", "c=written"], 2), (["a=option_unavailable", "b=missing", "c=missing"], 0)]


def test_all_but_best(spark):
    df = spark.createDataFrame([(1, "a"), (1, "bb"), (1, "cc"), (2, "a"), (None, "a"), (None, "b")], "g int, p string")
    assert values(ranking.all_but_best(df, "g", "p", F.length("p")), "g", "p") == [(1, "a"), (1, "bb")]
