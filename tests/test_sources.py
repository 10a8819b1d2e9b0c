"""Budgeted scans and attachments over path history."""

import os
import random
import shutil
from collections import Counter

import pytest

from siltworks.operators import trees
from siltworks.sources import budgeted


@pytest.mark.parametrize("seed", range(6))
def test_plans_meet_every_page_within_their_budget(seed):
    pick = random.Random(seed)
    pages = {f"p{i:02}": [("f", pick.randint(1, 50))] for i in range(pick.randint(1, 30))}
    counts = {name: pick.randint(1, 40) for name in pages}
    rows, size, newest, retries = pick.randint(5, 60), pick.randint(20, 90), pick.randint(0, 2), pick.randint(0, 2)
    of = {id(v): counts[k] for k, v in pages.items()}
    after, met, partial, turned = budgeted.START, {}, sorted(pick.sample(sorted(pages), min(3, len(pages)))), Counter()
    for run in range(2 * len(pages) + 2):
        after = budgeted.plan_run(after, pages, partial, lambda v: of[id(v)], rows, size, newest, retries)
        assert len(after["pages"]) == len(set(after["pages"])) and after["run"] == run + 1
        # the first page behind the cursor may be over the budget, the others never are
        rest = after["pages"][1:]
        if rest:
            assert sum(counts[p] for p in after["pages"]) <= max(rows, counts[after["pages"][0]]) + (0 if counts[after["pages"][0]] <= rows else -1)
        for p in after["pages"]:
            met.setdefault(p, run)
            turned[p] += 1
        assert set(after["retry"]) == set(partial)
    assert set(met) == set(pages) and max(met.values()) < len(pages)
    assert after["sweep"] >= 1


def test_partial_pages_take_turns():
    pages = {f"p{i}": [("f", 1)] for i in range(9)}
    after, seen = dict(budgeted.START, cursor="p5"), []
    for _ in range(6):
        after = budgeted.plan_run(after, pages, ["p0", "p1", "p2"], lambda v: 1, 2, 100, 0, 1)
        seen.append(after["pages"][1] if len(after["pages"]) > 1 else None)
    assert [x for x in seen if x in ("p0", "p1", "p2")][:3] == ["p0", "p1", "p2"]


SCHEMA = "id long, v string"


def rows_of(spark, out):
    return sorted((r.run, r.page, r.id, r.problem) for r in spark.read.schema(f"{SCHEMA}, {budgeted.ADDED}").parquet(out).collect())


def test_runs_go_on_and_broken_pages_come_again(spark, tmp_path):
    for i in range(5):
        spark.createDataFrame([(10 * i + k, "x") for k in range(2)], SCHEMA).coalesce(1).write.parquet(f"file://{tmp_path}/pages/p{i}")
    part = next(f for f in os.listdir(tmp_path / "pages/p1") if f.startswith("part"))
    whole = (tmp_path / "pages/p1" / part).read_bytes()
    (tmp_path / "pages/p1" / part).write_bytes(whole[:40])
    out, checkpoint = f"file://{tmp_path}/out", f"file://{tmp_path}/checkpoint"
    run = lambda: budgeted.run_budgeted(spark, str(tmp_path / "pages"), SCHEMA, out, checkpoint, rows=4, retries=1)
    assert run()["cursor"] == "p2"  # of the damaged page no rows are known
    assert rows_of(spark, out) == [(1, "p0", 0, None), (1, "p0", 1, None), (1, "p1", None, "ArrowInvalid"), (1, "p2", 20, None), (1, "p2", 21, None)]
    # the run is lost before it is committed: it is read again as planned, and its rows are not doubled
    for name in os.listdir(tmp_path / "checkpoint/commits"):
        os.remove(tmp_path / "checkpoint/commits" / name)
    (tmp_path / "pages/p1" / part).write_bytes(whole)
    crc = tmp_path / "pages/p1" / f".{part}.crc"
    if crc.exists():
        os.remove(crc)
    before = rows_of(spark, out)
    assert run()["run"] == 1 and rows_of(spark, out) == before
    after = run()
    assert after["run"] == 2 and after["pages"] == ["p3", "p1"] and after["retry"] == ["p1"]
    run()
    got = rows_of(spark, out)
    assert got == sorted(set(got)) and [r for r in got if r[1] == "p1"] == [(1, "p1", None, "ArrowInvalid"), (2, "p1", 10, None), (2, "p1", 11, None)]
    assert {r[1] for r in got} == {"p0", "p1", "p2", "p3", "p4"} and budgeted.last_offset(spark, checkpoint)["retry"] == []
    shutil.rmtree(tmp_path / "pages")


def test_attachments_over_renames(spark):
    created = spark.createDataFrame([("a", 1), ("a", 10), ("z", 1)], "path string, at long")
    renamed = spark.createDataFrame([("b", "a", 5), ("c", "b", 7), ("b", "a", 12), ("d", "nowhere", 3), ("e", "d", 4)], "path string, source string, at long")
    history = trees.path_history(created, renamed)
    assert sorted((r.path, r.start, r.end, r.file) for r in history.collect()) == [
        ("a", 1, 5, "a@1"), ("a", 10, 12, "a@10"), ("b", 5, 7, "a@1"), ("b", 12, None, "a@10"), ("c", 7, None, "a@1"), ("d", 3, 4, None), ("e", 4, None, None), ("z", 1, None, "z@1"),
    ]
    receipts = [("r1", "a@1", "u1", "s", 5, True), ("r2", "a@10", "u2", "s", 5, True), ("r3", "a@10", "u3", "s", 5, True), ("r4", "z@1", "u4", "s", 5, False)]
    blocks = [(1, "c", 9, "u1", None, None), (2, "b", 6, None, "s", 5), (3, "b", 13, None, "s", 5), (4, "b", 13, "u3", "x", 1), (5, "a", 7, "u1", None, None), (6, "e", 9, "u1", None, None), (7, "z", 2, "u4", None, None), (8, "c", 9, "u9", None, None), (9, "c", 9, None, "s", 6)]
    found = trees.bound_attachments(
        spark.createDataFrame(blocks, "k int, path string, at long, upload_id string, sha256 string, size long"), history,
        spark.createDataFrame(receipts, "receipt string, file string, upload_id string, sha256 string, size long, verified boolean"), "k",
    )
    assert {r.k: (r.receipt, r.outcome) for r in found.collect()} == {
        1: ("r1", "bound"), 2: ("r1", "bound"), 3: (None, "ambiguous"), 4: ("r3", "bound"), 5: (None, "no_file"), 6: (None, "no_file"), 7: (None, "unverified"), 8: (None, "missing"), 9: (None, "missing"),
    }
