"""What to do with each record of a source: proposals against what is registered and what is there; hydration of cut lists."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltworks.sources.paged import chain_outcomes

#: Outcomes of a proposal (fixed order); a conflict has a reason.
OUTCOMES = ("created", "preview_imported", "updated", "state_only", "unchanged", "conflicted", "detail_required")


def propose(summaries: DataFrame, details: DataFrame, registry: DataFrame, current: DataFrame, previews: DataFrame, reserved: DataFrame) -> DataFrame:
    """One row an id that is registered or listed: (id, path, outcome, reason).

    ``summaries`` (id, version, summary); ``details`` (id, created, rendered, path):
    a record's full text as a hash, and where it would go; ``registry`` (id, version,
    summary, created, path, mirror): what was written last; ``current`` (path, id,
    content): what is there, by hash; ``previews`` (id, path, rendered): approved
    before; ``reserved`` (id). Of the rules the first that fits counts: an id in two
    files or reserved (``identity_reserved``), not in the source any more
    (``source_missing``), a registered file gone or edited (``local_note_edited``),
    nothing new (unchanged), an id that is there unregistered
    (``identity_reserved``), a missing detail (detail_required), another creation
    time (``source_created_changed``), a new text (updated) or the same
    (state_only), a path that is taken, there or by a smaller id of this batch
    (``destination_collision``), the approved preview (preview_imported), else created.
    """
    files = current.groupBy("id").agg((F.count("*") > 1).alias("many"), F.lit(True).alias("present")).where("id is not null")
    at_path = current.groupBy("path").agg(F.min("content").alias("content"))
    ids = summaries.select("id").unionByName(registry.select("id")).distinct()
    base = (
        ids.join(summaries.select("id", "version", "summary", F.lit(True).alias("listed")), "id", "left")
        .join(details.select("id", "created", "rendered", F.col("path").alias("new_path"), F.lit(True).alias("detailed")), "id", "left")
        .join(registry.select("id", F.col("version").alias("old_version"), F.col("summary").alias("old_summary"), F.col("created").alias("old_created"), F.col("path").alias("old_path"), "mirror", F.lit(True).alias("registered")), "id", "left")
        .join(files, "id", "left").join(previews.select("id", F.col("path").alias("preview_path"), F.col("rendered").alias("approved"), F.lit(True).alias("previewed")), "id", "left")
        .join(reserved.select("id", F.lit(True).alias("kept_back")).distinct(), "id", "left")
    )
    exact = F.col("previewed") & F.col("approved").eqNullSafe(F.col("rendered"))
    path = F.when(F.col("registered"), F.col("old_path")).when(exact, F.col("preview_path")).otherwise(F.col("new_path"))
    here = base.withColumn("path", path).join(at_path, "path", "left")
    fresh = F.col("registered").isNull() & F.col("detailed") & F.col("listed") & F.col("present").isNull() & F.col("kept_back").isNull()
    first = here.where(fresh & F.col("path").isNotNull()).groupBy("path").agg(F.min("id").alias("first_id"))
    whole = here.join(first, "path", "left")
    conflict = lambda reason: F.struct(F.lit("conflicted").alias("outcome"), F.lit(reason).alias("reason"))
    made = lambda outcome: F.struct(F.lit(outcome).alias("outcome"), F.lit(None).cast("string").alias("reason"))
    old = F.col("registered").isNotNull()
    decided = (
        F.when(F.col("many") | F.col("kept_back"), conflict("identity_reserved")).when(F.col("listed").isNull(), conflict("source_missing"))
        .when(old & ~F.col("content").eqNullSafe(F.col("mirror")), conflict("local_note_edited"))
        .when(old & F.col("version").eqNullSafe(F.col("old_version")) & F.col("summary").eqNullSafe(F.col("old_summary")), made("unchanged"))
        .when(~old & F.col("present"), conflict("identity_reserved")).when(F.col("detailed").isNull(), made("detail_required"))
        .when(old & ~F.col("created").eqNullSafe(F.col("old_created")), conflict("source_created_changed"))
        .when(old, F.when(F.col("rendered").eqNullSafe(F.col("content")), made("state_only")).otherwise(made("updated")))
        .when(F.col("content").isNotNull() | (F.col("first_id") != F.col("id")), conflict("destination_collision")).when(exact, made("preview_imported")).otherwise(made("created"))
    )
    return whole.withColumn("d", decided).select("id", "path", "d.outcome", "d.reason")


def hydrate(records: DataFrame, pages: DataFrame, key: str, prop: str) -> DataFrame:
    """Cut lists completed from their pages: rows (key, prop, items, outcome).

    ``records`` (key, prop, items, has_more, total): a list as its record shows it.
    One that says it has no more is ``whole`` as it stands. Of another the pages
    (key, prop, place, cursor, next, has_more, rows of (id)) must be a complete
    chain (:func:`siltworks.sources.paged.chain_outcomes`; ids may come twice in a
    list) and start with what the record shows (``prefix_changed`` if not); it is
    ``hydrated`` then, in order of the pages. A fault leaves the cut list and says
    so, and a list without any page is ``missing``.
    """
    chain = F.struct(F.col(key), F.col(prop))
    listed = pages.withColumn("chain", chain).withColumn("bytes", F.lit(0).cast("long")).withColumn("total", F.lit(None).cast("long"))
    # repeated items are allowed, so they are told apart by their place
    told = listed.withColumn("rows", F.transform("rows", lambda r, i: F.struct(F.struct(r["id"], F.col("place"), i).alias("id"))))
    outcomes = chain_outcomes(told).select(F.col(f"chain.{key}").alias(key), F.col(f"chain.{prop}").alias(prop), F.col("outcome").alias("fault"))
    # the items of one list
    joined = F.flatten(F.transform(F.sort_array(F.collect_list(F.struct("place", "rows"))), lambda p: F.transform(p["rows"], lambda r: r["id"])))
    full = pages.groupBy(key, prop).agg(joined.alias("full"))
    both = records.join(outcomes, [key, prop], "left").join(full, [key, prop], "left")
    shown = F.coalesce(F.col("items"), F.array().cast(records.schema["items"].dataType))
    outcome = (
        F.when(~F.col("has_more"), "whole").when(F.col("fault").isNull(), "missing").when(F.col("fault") != "complete", F.col("fault")).when(F.slice("full", F.lit(1), F.size(shown)) != shown, "prefix_changed").otherwise("hydrated")
    )
    done = both.withColumn("outcome", outcome)
    return done.select(key, prop, F.when(F.col("outcome") == "hydrated", F.col("full")).otherwise(F.col("items")).alias("items"), "outcome")
