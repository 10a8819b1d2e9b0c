"""Ranked selection: caps, queues, rotations, streaks. Every order ends in a tie-breaker."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siltworks.sources.state import kept


def top_per_group(df: DataFrame, group: Sequence[str], order: Sequence[Column], limit: int, rank: str = "rank") -> DataFrame:
    """The first ``limit`` rows of each group. Spark prunes in each task before the shuffle."""
    w = Window.partitionBy(*group).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(w).cast("long")).where(F.col(rank) <= limit)


def with_overflow(df: DataFrame, group: Sequence[str], order: Sequence[Column], limit: int) -> DataFrame:
    """The first ``limit`` rows of each group and how many more the group has."""
    sizes = df.groupBy(*group).agg(F.count("*").alias("__size"))
    top = top_per_group(df, group, order, limit)
    return top.join(sizes, list(group)).withColumn("overflow", F.greatest(F.col("__size") - limit, F.lit(0))).drop("__size")


def with_ties(df: DataFrame, group: Sequence[str], *order: Column) -> DataFrame:
    """All rows that share the first place of their group."""
    return df.withColumn("__r", F.rank().over(Window.partitionBy(*group).orderBy(*order))).where("__r = 1").drop("__r")


def all_but_best(df: DataFrame, group: str, key: str, order: Column) -> DataFrame:
    """The rows of each group but the one that ``order`` puts highest; ``key`` tells its rows apart. A null group has no rows to give up."""
    # a maximum that tasks take before the shuffle, so a large group is not sorted in one task
    best = df.where(F.col(group).isNotNull()).groupBy(group).agg(F.max(F.struct(order.alias("__order"), F.col(key).alias("__best"))).alias("__top"))
    return df.join(best.select(group, F.col("__top.__best").alias("__best")), group).where(~F.col(key).eqNullSafe(F.col("__best"))).drop("__best")


def fair_order(df: DataFrame, key: str, arrival: str, limit: int, cursor: int | None = None) -> DataFrame:
    """The next ``limit`` rows of a fair drain, numbered by ``position``.

    First in first out inside a key, keys in turn by their first arrival. Keys whose
    first arrival is at most ``cursor`` come last in each turn, so a drain starts
    after it. No key gives more than ``limit`` rows, so each task keeps no more of one.
    """
    first = df.groupBy(key).agg(F.min(arrival).alias("__first"))
    turns = top_per_group(df, [key], [F.col(arrival)], limit, "turn").join(first, key)
    wrapped = (F.col("__first") <= F.lit(cursor)) if cursor is not None else F.lit(False)
    taken = turns.withColumn("wrapped", wrapped).orderBy("turn", "wrapped", "__first").limit(limit)
    return taken.withColumn("position", F.row_number().over(Window.orderBy("turn", "wrapped", "__first")).cast("long")).drop("__first")


def numbered(df: DataFrame, group: str, order: str, out: str = "number") -> DataFrame:
    """Adds ``out``: 1, 2, ... by ``order`` inside each group, without gathering a group in one task.

    Rows are dealt into ranges of (group, order) and counted inside them; a range's
    offset for a group is what earlier ranges hold of it. The rows are written with
    their range: ranges come from a sample and are merged by size, so a plan that
    deals the rows out twice gets two different divisions.
    """
    ranged = kept(df.repartitionByRange(group, order).withColumn("__part", F.spark_partition_id()), "numbered")
    placed = ranged.withColumn("__n", F.row_number().over(Window.partitionBy("__part", group).orderBy(order)))
    # one row for each range and group that meet
    sizes = placed.groupBy("__part", group).agg(F.count("*").alias("__size"))
    before = F.sum("__size").over(Window.partitionBy(group).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1))
    offsets = sizes.select(F.col("__part").alias("__in"), F.col(group).alias("__of"), F.coalesce(before, F.lit(0)).alias("__start"))
    # rows without a group are a group too
    both = placed.join(offsets, (F.col("__part") == F.col("__in")) & F.col(group).eqNullSafe(F.col("__of")))
    return both.withColumn(out, (F.col("__start") + F.col("__n")).cast("long")).select(*df.columns, out)


def after_cursor(df: DataFrame, key: str, cursor, limit: int) -> DataFrame:
    """The next ``limit`` rows after a cursor, going round at the end."""
    return df.orderBy(F.col(key) <= F.lit(cursor), key).limit(limit)


def page_after(df: DataFrame, keys: Sequence[str], last: Sequence, limit: int) -> DataFrame:
    """Keyset page: rows whose key tuple is greater than ``last``, in order."""
    tuple_of = F.struct(*keys)
    return df.where(tuple_of > F.struct(*(F.lit(v).alias(k) for k, v in zip(keys, last, strict=True)))).orderBy(*keys).limit(limit)


def queue_order(arrivals: DataFrame, key: str, seq: str) -> DataFrame:
    """A queue where a key that arrives again moves to the tail: rows (key, last)."""
    return arrivals.groupBy(key).agg(F.max(seq).alias("last"))


def streaks(periods: DataFrame, group: str, period: str, success: str) -> DataFrame:
    """Rows (group, longest, longest_end, current) over consecutive integer periods.

    A missing period breaks a streak; of equal streaks the earliest counts;
    ``current`` is the streak that ends at the group's last period.
    """
    good = periods.where(F.col(success)).select(group, period).distinct()
    w = Window.partitionBy(group).orderBy(period)
    runs = good.withColumn("run", F.col(period) - F.row_number().over(w)).groupBy(group, "run").agg(F.count("*").alias("n"), F.max(period).alias("end"))
    last = periods.groupBy(group).agg(F.max(period).alias("last"))
    best = runs.groupBy(group).agg(F.max(F.struct(F.col("n"), (-F.col("end")).alias("neg"))).alias("best"), F.max(F.struct("end", "n")).alias("latest"))
    joined = last.join(best, group, "left")
    current = F.when(F.col("latest.end") == F.col("last"), F.col("latest.n")).otherwise(F.lit(0))
    return joined.select(group, F.coalesce("best.n", F.lit(0)).alias("longest"), (-F.col("best.neg")).alias("longest_end"), current.alias("current"))


def contiguous(df: DataFrame, key: str, seq: str) -> DataFrame:
    """Rows (key, gaps): how often a sequence number does not follow the one before."""
    step = F.col(seq) - F.lag(seq).over(Window.partitionBy(key).orderBy(seq))
    return df.withColumn("__step", step).groupBy(key).agg(F.count_if(F.col("__step") != 1).alias("gaps"))


def change_points(df: DataFrame, group: str, order: str, value: str) -> DataFrame:
    """The rows of a history whose value differs from the row before; the first row counts."""
    w = Window.partitionBy(group).orderBy(order)
    return df.withColumn("__b", F.lag(value).over(w)).withColumn("__k", F.row_number().over(w)).where(F.col("__k").eqNullSafe(1) | ~F.col("__b").eqNullSafe(F.col(value))).drop("__b", "__k")
