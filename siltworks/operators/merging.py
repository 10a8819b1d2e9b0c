"""Merges of versions, plans for sinks, and folds over short ordered lists."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def three_way(desired: Column, current: Column, managed: Column, fill_empty: bool = True) -> Column:
    """What to do with one field: keep, write, adopt or hold (edited by hand).

    ``managed`` is what this side wrote last. A current value that differs from it
    was edited and is held, unless it already is what is desired.
    """
    empty = current.isNull() | (current == "")
    return (
        F.when(desired.eqNullSafe(current), F.when(managed.eqNullSafe(current), "keep").otherwise("adopt"))
        .when(managed.eqNullSafe(current), "write").when(empty & managed.isNull() & F.lit(fill_empty), "write").otherwise("hold")
    )


def sink_plan(wanted: DataFrame, target: DataFrame, key: str, version: str, managed: str) -> DataFrame:
    """Rows (key, action): create, noop, update or blocked, by hashes of what is wanted, seen and last written."""
    seen = target.select(F.col(key), F.col(version).alias("__seen"), F.col(managed).alias("__mine")).withColumn("__here", F.lit(True))
    action = F.when(F.col("__here").isNull(), "create").when(F.col(version).eqNullSafe(F.col("__seen")), "noop").when(F.col("__seen").eqNullSafe(F.col("__mine")), "update").otherwise("blocked")
    return wanted.join(seen, key, "left").select(key, action.alias("action"))


def visibility(before: Column, after: Column) -> Column:
    """For maps of id lists: the ids that each relation lost."""
    lost = F.map_zip_with(before, after, lambda k, a, b: F.array_except(F.coalesce(a, F.array().cast("array<bigint>")), F.coalesce(b, F.array().cast("array<bigint>"))))
    return F.map_filter(lost, lambda k, v: F.size(v) > 0)


def batches(items: Column, count: int, weight: int) -> Column:
    """Batch number of each item of an ordered array of weights: greedy, at most ``count`` items and ``weight`` in all.

    An item heavier than ``weight`` has a batch of its own.
    """
    start = F.struct(F.lit(0).alias("batch"), F.lit(0).alias("n"), F.lit(0).cast("long").alias("w"), F.array().cast("array<int>").alias("out"))

    def add(a: Column, x: Column) -> Column:
        full = (a["n"] > 0) & ((a["n"] >= count) | (a["w"] + x > weight))
        batch = F.when(full, a["batch"] + 1).otherwise(a["batch"])
        return F.struct(batch.alias("batch"), F.when(full, 1).otherwise(a["n"] + 1).alias("n"), F.when(full, x).otherwise(a["w"] + x).cast("long").alias("w"), F.concat(a["out"], F.array(batch)).alias("out"))

    return F.aggregate(items, start, add)["out"]


def batch_ends(items: Column, limits: Sequence[int]) -> Column:
    """Places behind each batch of an ordered array of weights (one array each): greedy, under all ``limits`` at once.

    An item over a limit by itself has a batch of its own. The array grows by one
    for each batch, not for each item, so long arrays cost little more than their length.
    """
    fields = [f"w{i}" for i in range(len(limits))]
    start = F.struct(F.lit(0).alias("n"), *(F.lit(0).cast("long").alias(f) for f in fields), F.array().cast("array<int>").alias("out"))

    def add(a: Column, x: Column) -> Column:
        full = F.lit(False)
        for i, (f, limit) in enumerate(zip(fields, limits, strict=True)):
            full = full | (a[f] + x[i] > limit)
        full = (a["n"] > 0) & full
        sums = [F.when(full, x[i]).otherwise(a[f] + x[i]).alias(f) for i, f in enumerate(fields)]
        return F.struct((a["n"] + 1).alias("n"), *sums, F.when(full, F.concat(a["out"], F.array(a["n"]))).otherwise(a["out"]).alias("out"))

    return F.aggregate(items, start, add, lambda a: F.when(a["n"] > 0, F.concat(a["out"], F.array(a["n"]))).otherwise(a["out"]))


def batches_within(items: Column, limits: Sequence[int]) -> Column:
    """Batch number of each item of an ordered array of weights; see :func:`batch_ends`."""
    numbers = lambda ends: F.flatten(F.transform(ends, lambda e, i: F.array_repeat(i, e - F.when(i > 0, F.get(ends, i - 1)).otherwise(0))))
    # as an element, so that the ends are worked out once
    return F.get(F.transform(F.array(batch_ends(items, limits)), numbers), F.lit(0))


def merge_runs(items: Column) -> Column:
    """Neighbouring (kind, text) structs of one kind joined into one."""
    start = F.array().cast("array<struct<kind:string,text:string>>")

    def add(a: Column, x: Column) -> Column:
        last = F.get(a, F.size(a) - 1)
        joined = F.concat(F.slice(a, F.lit(1), F.size(a) - 1), F.array(F.struct(last["kind"].alias("kind"), F.concat(last["text"], x["text"]).alias("text"))))
        return F.when((F.size(a) > 0) & (last["kind"] == x["kind"]), joined).otherwise(F.concat(a, F.array(F.struct(x["kind"].alias("kind"), x["text"].alias("text")))))

    return F.aggregate(items, start, add)


def choose_themes(ranked: Column, limit: int = 3) -> Column:
    """Names from (name, weight, support, seen) in rank order; later places ask for more.

    The first is taken as it is, a further one only with support of two sources or
    if it was not seen lately, and none once ``limit`` are taken.
    """
    start = F.array().cast("array<string>")
    fits = lambda a, x: (F.size(a) < limit) & ((F.size(a) == 0) | (x["support"] >= 2) | (x["seen"] == 0))
    return F.aggregate(ranked, start, lambda a, x: F.when(fits(a, x), F.concat(a, F.array(x["name"]))).otherwise(a))


def unmanaged_suffix(whole: Column, managed: Column) -> Column:
    """What follows a managed prefix, null where the prefix was changed."""
    return F.when(F.slice(whole, F.lit(1), F.size(managed)) == managed, F.slice(whole, F.size(managed) + 1, F.size(whole)))


def keep_newest(blocks: DataFrame, group: Sequence[str], period: str, seq: str, limit: int = 5) -> DataFrame:
    """One block for each period, the last written, and of those the newest ``limit`` periods."""
    from siltworks.operators.changes import latest
    from siltworks.operators.ranking import top_per_group

    return top_per_group(latest(blocks, [*group, period], F.desc(seq)), group, [F.desc(period)], limit)
