"""Snapshots: versions, differences, upserts. Absence from a snapshot is not deletion unless asked for."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def version_of(*columns: str | Column) -> Column:
    """SHA-256 over the values in the given order; null and empty differ."""
    parts = [F.coalesce(F.concat(F.lit("="), (F.col(c) if isinstance(c, str) else c).cast("string")), F.lit("~")) for c in columns]
    return F.sha2(F.concat_ws("\n", *parts), 256)


def snapshot_diff(prior: DataFrame, current: DataFrame, key: str, version: str) -> DataFrame:
    """Rows (key, before, after, change) of a full join: added, removed, changed or unchanged."""
    a = prior.select(F.col(key), F.col(version).alias("before"), F.lit(True).alias("in_prior"))
    b = current.select(F.col(key), F.col(version).alias("after"), F.lit(True).alias("in_current"))
    change = F.when(F.col("in_prior").isNull(), "added").when(F.col("in_current").isNull(), "removed").when(F.col("before").eqNullSafe(F.col("after")), "unchanged").otherwise("changed")
    return a.join(b, key, "full").select(key, "before", "after", change.alias("change"))


def latest(df: DataFrame, keys: Sequence[str], *order: Column) -> DataFrame:
    """One row for each key, the first in ``order``; give a last tie-breaker for a stable result."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__n", F.row_number().over(w)).where("__n = 1").drop("__n")


def upsert(state: DataFrame, rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``state`` with ``rows`` in place of those of equal keys; what rows do not mention stays."""
    return state.join(rows.select(*keys).distinct(), list(keys), "left_anti").unionByName(rows)


def insert_new(state: DataFrame, rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``state`` with those of ``rows`` whose keys it lacks, one row for each key."""
    return state.unionByName(rows.dropDuplicates(list(keys)).join(state.select(*keys), list(keys), "left_anti"))


def changed_only(state: DataFrame, rows: DataFrame, keys: Sequence[str], version: str) -> DataFrame:
    """Those of ``rows`` that are new or differ from ``state``: what a write has to touch."""
    same = state.select(*keys, F.col(version).alias("__held")).withColumn("__here", F.lit(True))
    return rows.join(same, list(keys), "left").where("__here is null or not (__held <=> " + version + ")").drop("__held", "__here")


def classify_scan(scan: DataFrame, state: DataFrame, key: str, version: str, first_scan: bool = False) -> DataFrame:
    """Outcome of each scanned row: baseline, new, changed or unchanged. The first scan only sets the baseline."""
    known = state.select(F.col(key), F.col(version).alias("__held")).withColumn("__here", F.lit(True))
    outcome = F.when(F.lit(first_scan), "baseline").when(F.col("__here").isNull(), "new").when(F.col("__held").eqNullSafe(F.col(version)), "unchanged").otherwise("changed")
    return scan.join(known, key, "left").withColumn("outcome", outcome).drop("__held", "__here")


def set_counts(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """One row: keys in both, only in ``a``, only in ``b``, and keys that either has twice."""
    left = a.groupBy(key).agg(F.count("*").alias("na"))
    right = b.groupBy(key).agg(F.count("*").alias("nb"))
    return left.join(right, key, "full").agg(
        F.count_if(F.col("na").isNotNull() & F.col("nb").isNotNull()).alias("in_both"),
        F.count_if(F.col("nb").isNull()).alias("only_left"),
        F.count_if(F.col("na").isNull()).alias("only_right"),
        F.count_if((F.col("na") > 1) | (F.col("nb") > 1)).alias("duplicated"),
    )


def retained(state: DataFrame, scan: DataFrame, key: str) -> DataFrame:
    """Rows of the state that a scan did not show; they stay in the state."""
    return state.join(scan.select(key).distinct(), key, "left_anti")


def tree_fingerprint(df: DataFrame, *columns: str) -> DataFrame:
    """One row: the number of rows and a fingerprint of them that does not depend on their order.

    Four sums over parts of the rows' SHA-256 hashes: tasks add up their own rows,
    so nothing is gathered, and a repeated row counts each time.
    """
    rows = df.select(version_of(*columns).alias("h"))
    part = lambda i: F.conv(F.substr("h", F.lit(15 * i + 1), F.lit(15)), 16, 10).cast("decimal(38,0)")
    # 60-bit parts: a sum of 10**18 rows still fits 38 digits
    sums = rows.agg(F.count("*").alias("rows"), *(F.coalesce(F.sum(part(i)), F.lit(0)).alias(f"s{i}") for i in range(4)))
    return sums.select("rows", F.sha2(F.concat_ws(":", *(F.col(f"s{i}").cast("decimal(38,0)").cast("string") for i in range(4))), 256).alias("fingerprint"))
