"""Ordered lists against each other: manifests, and documents that are appended to."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltworks.operators import ranking
from siltworks.operators.merging import batch_ends
from siltworks.sources.state import forget, kept

#: Places whose rows are summed into one fingerprint.
SPAN = 4096


def placed(rows: DataFrame, order: str, values: Sequence[str]) -> DataFrame:
    """Rows (place, row): their place in the order and a hash of place and values."""
    one = rows.select(F.lit(0).alias("__all"), F.col(order).alias("__order"), F.struct(*values).alias("row"))
    counted = ranking.numbered(one, "__all", "__order", "place")
    return counted.select("place", "row", F.xxhash64("place", "row").alias("mark"))


def compare_ordered(left: DataFrame, right: DataFrame, order: str, values: Sequence[str]) -> DataFrame:
    """One row: whether two ordered lists are equal, and the first place where they differ.

    ``order`` tells the rows of a list apart. A list's places are counted in ranges,
    each span of places has the sum of its rows' marks, and only the first span
    whose sums differ is compared row by row; so a swap, an insertion and a row that
    comes twice are found without either list in one task. Equal to comparing the
    lists but for spans whose different marks have one sum (odds of 2^-64 each).
    ``left_row`` and ``right_row`` are null where a list has ended.
    """
    lists = [kept(placed(df, order, values), "manifest") for df in (left, right)]
    span = F.floor((F.col("place") - 1) / SPAN).alias("span")
    sums = [df.groupBy(span).agg(F.sum(F.col("mark").cast("decimal(38,0)")).alias(f"sum{i}"), F.count("*").alias(f"n{i}")) for i, df in enumerate(lists)]
    spans = kept(sums[0].join(sums[1], "span", "full"), "manifest-spans")
    totals = spans.agg(
        F.coalesce(F.sum("n0"), F.lit(0)).alias("n_left"), F.coalesce(F.sum("n1"), F.lit(0)).alias("n_right"),
        F.min(F.when(~F.col("sum0").eqNullSafe(F.col("sum1")) | ~F.col("n0").eqNullSafe(F.col("n1")), F.col("span"))).alias("span"),
    )
    found = totals.first()
    low = (found.span if found.span is not None else -1) * SPAN
    # one span of each list
    part = [df.where(F.col("place").between(low + 1, low + SPAN)).select("place", F.col("row").alias(f"row{i}")) for i, df in enumerate(lists)]
    different = part[0].join(part[1], "place", "full").where(~F.col("row0").eqNullSafe(F.col("row1")))
    first = different.agg(F.min(F.struct("place", F.to_json("row0").alias("left_row"), F.to_json("row1").alias("right_row"))).alias("d"))
    out = first.select(
        F.lit(found.span is None).alias("equal"), F.lit(found.n_left).alias("n_left"), F.lit(found.n_right).alias("n_right"), F.col("d.place").alias("first_difference"), F.col("d.left_row"), F.col("d.right_row")
    )
    forget(spans)
    return out


def outside_scope(paths: DataFrame, path: str, size: str, allowed: Sequence[str], largest: int) -> DataFrame:
    """Changed paths with the reason why they may not be published: ``scope`` or ``size``; those that may have none."""
    within = F.exists(F.array(*(F.lit(p) for p in allowed)), lambda p: F.startswith(F.col(path), p)) if allowed else F.lit(False)
    unsafe = F.coalesce(F.col(path).rlike(r"(\A|/)\.\.?(/|\z)|\A/|\\"), F.lit(True))
    reason = F.when(unsafe | ~F.coalesce(within, F.lit(False)), "scope").when(F.coalesce(F.col(size) > largest, F.lit(True)), "size")
    return paths.withColumn("reason", reason)


def append_plan(wanted: DataFrame, seen: DataFrame, intents: DataFrame, key: str, place: str, value: str, weight: str, count: int = 100, bytes_: int = 400_000) -> DataFrame:
    """What to append to each document: rows (key, shared, todo, outcome, batches).

    ``wanted`` and ``seen`` have the blocks of a document at places 0, 1, ...;
    ``intents`` says up to which place the last append was to go (key, up_to). A
    document goes on behind what is seen (``append``) or is ``complete``, unless the
    seen blocks are no prefix of those wanted (``modified``) or the last append, its
    response lost, is not all there (``reconcile``). ``batches`` are (first, last)
    places: at most ``count`` blocks and ``bytes_`` each; a larger block makes ``too_large``.
    """
    w = wanted.select(key, F.col(place).alias("at"), F.col(value).alias("w"), F.col(weight).cast("long").alias("size"))
    s = seen.select(key, F.col(place).alias("at"), F.col(value).alias("s"), F.lit(True).alias("here"))
    both = w.join(s, [key, "at"], "full").withColumn("bad", F.coalesce(F.col("here"), F.lit(False)) & ~(F.col("w").isNotNull() & F.col("w").eqNullSafe(F.col("s"))))
    rest = F.when(F.col("here").isNull(), F.struct("at", "size"))
    # the blocks of one document
    docs = both.groupBy(key).agg(
        F.count("w").alias("n"), F.count("here").alias("n_seen"), F.min(F.when(F.col("bad"), F.col("at"))).alias("bad_at"), F.sort_array(F.collect_list(rest)).alias("rest"),
        F.max(F.when(F.col("here").isNull(), F.col("size"))).alias("largest"),
    )
    known = docs.join(intents.select(key, "up_to"), key, "left")
    outcome = (
        F.when(F.col("bad_at").isNotNull(), "modified").when(F.col("up_to") > F.col("n_seen"), "reconcile").when(F.size("rest") == 0, "complete").when(F.col("largest") > bytes_, "too_large").otherwise("append")
    )
    counted = batch_ends(F.transform("rest", lambda x: F.array(F.lit(1).cast("long"), x["size"])), [count, bytes_])

    def spans(rest: Column, ends: Column) -> Column:
        begin = lambda i: F.when(i > 0, F.get(ends, i - 1)).otherwise(0)
        return F.transform(ends, lambda e, i: F.struct(F.get(rest, begin(i))["at"].alias("first"), F.get(rest, e - 1)["at"].alias("last")))

    # the ends as an element, so that they are worked out once
    with_batches = known.withColumn("outcome", outcome).withColumn("batches", F.when(F.col("outcome") == "append", F.get(F.transform(F.array(counted), lambda ends: spans(F.col("rest"), ends)), F.lit(0))))
    return with_batches.select(
        key, F.coalesce("bad_at", F.least("n_seen", "n")).cast("long").alias("shared"), F.when(F.col("outcome") == "append", F.size("rest")).otherwise(0).cast("long").alias("todo"), "outcome", "batches"
    )


def share_budget(candidates: DataFrame, group: str, key: str, kind: str, order: str, budget: int = 100, reserve: int = 25) -> tuple[DataFrame, DataFrame]:
    """What each group reads in one run, and what waits for the next: (key, group, slot) and (key, group, order).

    Kinds are ``audit``, ``deferred`` and ``fresh``. Audits have ``reserve`` slots;
    those they leave go to the changes. Of these, a third (1 to 25) is kept for
    fresh ones while older ones wait, and what the older ones leave goes to fresh
    ones too. A changed row that finds no slot is deferred, behind those deferred
    before it; an audit that finds none is simply left. Rows of a kind go in the
    order given, and no more than ``budget`` of one are ever ranked.
    """
    first = ranking.top_per_group(candidates, [group, kind], [F.col(order), F.col(key)], budget, "__rank")
    n = lambda k: F.least(F.count_if(F.col(kind) == k), F.lit(budget))
    counts = candidates.groupBy(group).agg(n("audit").alias("a"), n("deferred").alias("d"), n("fresh").alias("f"))
    changes = F.lit(budget) - F.col("audit_slots")
    slots = counts.withColumn("audit_slots", F.least("a", F.lit(reserve))).withColumn("changes", changes)
    keep_fresh = F.when(F.col("changes") > 0, F.least(F.lit(25), F.greatest(F.lit(1), F.floor(F.col("changes") / 3)))).otherwise(0)
    slots = slots.withColumn("deferred_slots", F.least("d", F.col("changes") - keep_fresh)).withColumn("fresh_slots", F.least("f", F.col("changes") - F.col("deferred_slots")))
    given = F.when(F.col(kind) == "audit", F.col("audit_slots")).when(F.col(kind) == "deferred", F.col("deferred_slots")).otherwise(F.col("fresh_slots"))
    taken = first.join(slots, group).where(F.col("__rank") <= given).select(key, group, F.col(kind).alias("slot"))
    waiting = candidates.where(F.col(kind).isin("deferred", "fresh")).join(taken.select(key), key, "left_anti")
    return taken, waiting.select(key, group, order)
