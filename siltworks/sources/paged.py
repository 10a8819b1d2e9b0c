"""Paged sources with a strict cursor contract.

Pages are rows (:func:`whole_chains`: chains of any length, those with a fault are
held) or lines ``{"cursor", "next", "has_more", "rows": [...]}`` of text files, a
file a chain (:func:`read_pages`: a fault stops the scan). A scan gives all rows of
a chain or none: a page without has_more, an empty page that promises more, a cursor
that comes twice or does not lead to the next page, or an end with a cursor left,
are faults. Ids that come twice in files are found by :func:`check_pages`.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


class ScanError(ValueError):
    """A page broke the contract."""


def chain(pages: Iterator[dict]) -> Iterator[dict]:
    """The rows of a chain of pages, all checked before the first is given out."""
    rows: list[dict] = []
    seen, expected, open_ended = set(), None, True
    for page in pages:
        if not open_ended:
            raise ScanError("a page follows the last one")
        if not isinstance(page.get("has_more"), bool) or not isinstance(page.get("rows"), list):
            raise ScanError("has_more or rows is missing")
        if expected is not None and page.get("cursor") != expected:
            raise ScanError("the cursor does not lead to this page")
        if page["has_more"]:
            expected = page.get("next")
            if not expected or expected in seen or not page["rows"]:
                raise ScanError("the cursor does not advance")
            seen.add(expected)
        elif page.get("next"):
            raise ScanError("the last page has a cursor")
        open_ended = page["has_more"]
        rows += page["rows"]
    if open_ended:
        raise ScanError("the last page is missing")
    yield from rows


def read_pages(spark: SparkSession, path: str, schema: str = "id string, updated_at string, body string") -> DataFrame:
    """Pages from text files that Spark reads: a file is a chain, checked whole in one task."""
    names = [x.split()[0] for x in schema.split(", ")]

    def run(batches):
        import pyarrow as pa

        for b in batches:
            for text in b.column(0).to_pylist():
                rows = list(chain(json.loads(line) for line in text.split("\n") if line))
                yield pa.RecordBatch.from_arrays([pa.array([None if r.get(n) is None else str(r.get(n)) for r in rows], pa.string()) for n in names], names)

    raw = spark.read.text(path, wholetext=True)
    return raw.mapInArrow(run, ", ".join(f"{n} string" for n in names))


def check_pages(rows: DataFrame, key: str = "id") -> DataFrame:
    """``rows``, or an error when any id comes twice, inside a page or between pages."""
    twice = rows.groupBy(key).agg(F.count("*").alias("__n")).where("__n > 1").limit(1).agg(F.count("*").alias("__bad"))
    checked = rows.crossJoin(F.broadcast(twice.select(F.assert_true(F.col("__bad") == 0, F.lit("an id comes twice")).alias("__ok"))))
    return checked.where("__ok is null").drop("__ok")


def with_details(summaries: DataFrame, details: DataFrame, key: str, *same: str) -> tuple[DataFrame, DataFrame]:
    """Summaries with their details, and those held with a reason: missing or differing in ``same``."""
    found = details.select(F.col(key), F.struct(*[c for c in details.columns if c != key]).alias("detail"))
    both = summaries.join(found, key, "left")
    agrees = F.lit(True)
    for c in same:
        agrees = agrees & F.col(c).eqNullSafe(F.col(f"detail.{c}"))
    reason = F.when(F.col("detail").isNull(), "detail_missing").when(~agrees, "detail_differs")
    marked = both.withColumn("reason", reason)
    return marked.where("reason is null").drop("reason"), marked.where("reason is not null").drop("detail")


def pages_of(df: DataFrame, key: str, size: int) -> DataFrame:
    """Adds ``page``: rows in order of ``key``, ``size`` to a page, counted inside range partitions.

    Offsets of partitions come from their counts, so no task orders all rows.
    """
    ranged = df.repartitionByRange(key).sortWithinPartitions(key).withColumn("__part", F.spark_partition_id())
    from pyspark.sql import Window

    counted = ranged.withColumn("__n", F.row_number().over(Window.partitionBy("__part").orderBy(key)))
    sizes = counted.groupBy("__part").agg(F.count("*").alias("__size"))
    starts = sizes.select("__part", (F.sum("__size").over(Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1))).alias("__start"))
    placed = counted.join(F.broadcast(starts), "__part")
    return placed.withColumn("page", F.floor((F.coalesce("__start", F.lit(0)) + F.col("__n") - 1) / size).cast("long")).drop("__part", "__n", "__start")


def scan_window(df: DataFrame, page: str, cursor: int, recent: int = 3, rotating: int = 3) -> DataFrame:
    """The newest pages, and the pages after a cursor that goes round: what a bounded scan reads."""
    last = df.agg(F.max(page)).first()[0]
    if last is None:
        return df
    sweep = [(cursor + i) % (last + 1) for i in range(rotating)]
    return df.where((F.col(page) < recent) | F.col(page).isin(sweep))


#: What can be wrong with a chain of pages, the first of these counts (fixed order).
FAULTS = ["shape", "cursor", "repeated_cursor", "empty_page", "end", "after_last", "missing_last", "repeated_id", "total", "bytes"]


def chain_outcomes(pages: DataFrame, chain: str = "chain", place: str = "place", most_bytes: int = 1 << 62) -> DataFrame:
    """Rows (chain, n_pages, n_rows, outcome) of pages (chain, place, cursor, next, has_more, total, bytes, rows).

    A page per row, so a chain is never in one task: a page meets the one before it
    by a join on place (0, 1, ...). ``outcome`` is ``complete``, or the first fault of
    :data:`FAULTS`: a page without has_more or rows; a cursor that the page before
    did not give; one given twice; an empty page that promises more; a last page
    with a cursor; a page behind the last; no last page; an id (field ``id`` of
    the rows) that comes twice; another number of rows than ``total`` (not checked
    where null); more bytes than ``most_bytes`` in all.
    """
    one = pages.select(
        F.col(chain).alias("chain"), F.col(place).alias("place"), "cursor", "next", "has_more", "total", "bytes", F.col("rows").isNotNull().alias("has_rows"), F.coalesce(F.size("rows"), F.lit(0)).alias("n")
    )
    before = one.select("chain", (F.col("place") + 1).alias("place"), F.col("next").alias("given"), F.col("has_more").alias("went_on"), F.lit(True).alias("has_before"))
    linked = one.join(before, ["chain", "place"], "left")
    given_again = one.where("next is not null").groupBy("chain", "next").count().where("count > 1").select("chain").distinct().withColumn("again", F.lit(True))
    ids = pages.select(F.col(chain).alias("chain"), F.explode("rows").alias("r")).groupBy("chain", F.col("r.id").alias("id")).count()
    twice = ids.where("count > 1").select("chain").distinct().withColumn("twice", F.lit(True))
    first = F.col("place") == 0
    any_of = lambda c: F.coalesce(F.max(c), F.lit(False))
    seen = linked.groupBy("chain").agg(
        F.count("*").alias("n_pages"), F.sum("n").alias("n_rows"), any_of(F.col("has_more").isNull() | ~F.col("has_rows")).alias("shape"),
        any_of(F.when(first, F.col("cursor").isNotNull()).otherwise(F.col("has_before").isNull() | ~F.col("cursor").eqNullSafe(F.col("given")))).alias("cursor"),
        any_of(F.col("has_more") & ((F.col("n") == 0) | F.col("next").isNull())).alias("empty_page"), any_of(~F.col("has_more") & F.col("next").isNotNull()).alias("end"),
        any_of(F.col("has_before") & ~F.coalesce("went_on", F.lit(True))).alias("after_last"), F.coalesce(F.max_by("has_more", "place"), F.lit(False)).alias("missing_last"),
        F.max("total").alias("most"), F.min("total").alias("least"), F.sum("bytes").alias("bytes"),
    )
    marked = seen.join(given_again, "chain", "left").join(twice, "chain", "left")
    hit = {
        "repeated_cursor": F.col("again"), "repeated_id": F.col("twice"), "total": (F.col("most") != F.col("n_rows")) | (F.col("least") != F.col("n_rows")), "bytes": F.col("bytes") > most_bytes,
    }
    outcome = F.coalesce(*(F.when(hit.get(f, F.col(f)), f) for f in FAULTS), F.lit("complete"))
    return marked.select("chain", "n_pages", "n_rows", outcome.alias("outcome"))


def whole_chains(pages: DataFrame, chain: str = "chain", place: str = "place", most_bytes: int = 1 << 62) -> tuple[DataFrame, DataFrame]:
    """The rows of complete chains, and the chains held with their fault: a scan gives all of a chain or nothing."""
    found = chain_outcomes(pages, chain, place, most_bytes)
    good = found.where("outcome = 'complete'").select(F.col("chain").alias(chain))
    rows = pages.join(good, chain, "left_semi").select(chain, F.explode("rows").alias("r")).select(chain, "r.*")
    return rows, found.where("outcome <> 'complete'")


def until_nothing_new(pages: DataFrame, chain: str = "chain", place: str = "place", key: str = "id") -> DataFrame:
    """Rows (chain, id, place) of chains that end where a page adds no new id: each id at its first page, none behind the end."""
    ids = pages.select(F.col(chain).alias("chain"), F.col(place).alias("place"), F.explode("rows").alias("r")).select("chain", "place", F.col(f"r.{key}").alias("id"))
    first = ids.groupBy("chain", "id").agg(F.min("place").alias("place"))
    adds = first.select("chain", "place").distinct().withColumn("adds", F.lit(True))
    idle = pages.select(F.col(chain).alias("chain"), F.col(place).alias("place")).join(adds, ["chain", "place"], "left").where("adds is null").groupBy("chain").agg(F.min("place").alias("end"))
    return first.join(idle, "chain", "left").where("end is null or place < end").select("chain", "id", "place")
