"""Joins with rules: cardinality, nearest prior, ranked matches, hierarchies, containment."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def link_if_unique(left: DataFrame, right: DataFrame, key: str, target: str) -> DataFrame:
    """Left rows with ``target`` where one right row fits, and outcome missing, linked or ambiguous.

    The right side is counted by key before the join, so no key multiplies rows.
    """
    sides = right.groupBy(key).agg(F.count("*").alias("__n"), F.min(target).alias("__t"))
    joined = left.join(sides, key, "left")
    outcome = F.when(F.coalesce("__n", F.lit(0)) == 0, "missing").when(F.col("__n") == 1, "linked").otherwise("ambiguous")
    return joined.withColumn("outcome", outcome).withColumn(target, F.when(F.col("__n") == 1, F.col("__t"))).drop("__n", "__t")


def asof_prior(left: DataFrame, right: DataFrame, day: str, within: int, *order: Column) -> DataFrame:
    """Each left row with the right row of the nearest earlier or equal day, at most ``within`` days back.

    Right rows are first reduced to the best of each day by ``order``, then each
    day is offered to the ``within`` days after it: an equi-join, without a range scan.
    """
    w = Window.partitionBy(day).orderBy(*order)
    best = right.withColumn("__k", F.row_number().over(w)).where("__k = 1").drop("__k")
    offered = best.withColumn("age", F.explode(F.sequence(F.lit(0), F.lit(within)))).withColumn("__day", F.date_add(day, F.col("age")))
    nearest = offered.withColumn("__k", F.row_number().over(Window.partitionBy("__day").orderBy("age"))).where("__k = 1").drop("__k")
    nearest = nearest.withColumnRenamed(day, f"prior_{day}").withColumnRenamed("__day", day)
    return left.join(nearest, day, "left")


def minus(df: DataFrame, key: Sequence[str], *others: DataFrame) -> DataFrame:
    """``df`` without the keys of any of ``others``."""
    for o in others:
        df = df.join(o.select(*key), list(key), "left_anti")
    return df


def path_nodes(df: DataFrame, path: str) -> DataFrame:
    """The nodes of a path hierarchy: (path, parent, depth, kind), each once."""
    parts = F.filter(F.split(path, "/"), lambda x: x != "")
    each = df.select(parts.alias("p")).where("size(p) > 0").distinct()
    each = each.select(F.explode(F.transform(F.sequence(F.lit(1), F.size("p")), lambda d: F.struct(F.array_join(F.slice("p", 1, d), "/").alias("path"), d.alias("depth"), (d == F.size("p")).alias("leaf")))).alias("n"))
    nodes = each.groupBy("n.path").agg(F.max("n.depth").cast("long").alias("depth"), F.min(F.col("n.leaf").cast("int")).alias("leaf"))
    parent = F.when(F.col("depth") > 1, F.regexp_replace("path", "/[^/]*$", ""))
    return nodes.select("path", parent.alias("parent"), "depth", F.when(F.col("leaf") == 1, "file").otherwise("directory").alias("kind"))


def contains_run(whole: Column, part: Column) -> Column:
    """How often an array occurs as a contiguous run in another."""
    n = F.size(part)
    starts = F.when((n > 0) & (F.size(whole) >= n), F.sequence(F.lit(1), F.size(whole) - n + 1)).otherwise(F.array().cast("array<int>"))
    return F.size(F.filter(starts, lambda i: F.slice(whole, i, n) == part)).cast("long")


def ranked_match(left: DataFrame, names: DataFrame, wanted: str, name: str) -> DataFrame:
    """Each wanted name with its best candidate: exact, then last word, then substring; ties by name.

    Every rank is an equi-join on a derived key (whole name, last word, each word),
    so candidates need not be compared with all names.
    """
    words = lambda c: F.split(F.lower(c), " ")
    last = lambda c: F.element_at(words(c), -1)
    a = left.select(F.col(wanted)).distinct()
    keys = lambda df, c: df.select(
        F.col(c),
        F.explode(F.concat(F.array(F.struct(F.lit(1).alias("r"), F.lower(c).alias("k"))), F.array(F.struct(F.lit(2).alias("r"), last(c).alias("k"))), F.transform(F.array_distinct(words(c)), lambda w: F.struct(F.lit(3).alias("r"), w.alias("k"))))).alias("e"),
    ).select(c, "e.r", "e.k")
    hits = keys(a, wanted).join(keys(names.select(name).distinct(), name), ["r", "k"])
    best = hits.groupBy(wanted).agg(F.min(F.struct("r", name)).alias("m"))
    return best.select(wanted, F.col("m.r").cast("long").alias("match_rank"), F.col(f"m.{name}").alias(name))


def resolved_tags(wanted: DataFrame, names: DataFrame, tag: str, name: str) -> DataFrame:
    """Each wanted tag with its best name: equal (1), equal to the last part of its path (2), inside a name (3), else the first name of all (4).

    Ties by name; case does not count. Each rank is an equi-join on keys of the
    names: whole, last part, and every part of it as long as some wanted tag, so no
    tag is compared with all names. Names are short, which bounds their keys.
    """
    a = wanted.select(F.col(tag)).where(F.col(tag).isNotNull()).distinct()
    b = names.select(F.col(name)).where(F.col(name).isNotNull()).distinct()
    lengths = [r[0] for r in a.select(F.length(tag)).distinct().collect() if r[0]]  # lengths of tags: a few numbers
    low, none = F.lower(name), F.array().cast("array<string>")

    def parts_of(n: int) -> Column:
        return F.when(F.length(low) >= n, F.transform(F.sequence(F.lit(1), F.length(low) - n + 1), lambda i: F.substr(low, i, F.lit(n)))).otherwise(none)

    pieces = F.flatten(F.array(*map(parts_of, sorted(lengths)))) if lengths else none
    keyed = lambda rank, key: F.struct(F.lit(rank).alias("r"), key.alias("k"))
    keys = F.concat(F.array(keyed(1, low), keyed(2, F.element_at(F.split(low, "/"), -1))), F.transform(F.array_distinct(pieces), lambda p: keyed(3, p)))
    index = b.select(name, F.explode(keys).alias("e")).groupBy("e.r", "e.k").agg(F.min(name).alias(name))
    asked = a.select(tag, F.lower(tag).alias("k"))
    best = asked.join(index, "k", "left").groupBy(tag).agg(F.min(F.struct("r", name)).alias("m"))
    last = b.agg(F.min(name).alias("__first"))
    out = best.crossJoin(F.broadcast(last))  # one row
    found = F.col("m.r").isNotNull()
    return out.select(tag, F.when(found, F.col("m.r")).when(F.col("__first").isNotNull(), 4).cast("long").alias("match_rank"), F.when(found, F.col(f"m.{name}")).otherwise(F.col("__first")).alias(name))


def unique_best(df: DataFrame, group: str, name: str, score: str, keyword: Column) -> DataFrame:
    """Rows (group, outcome, choice): the one candidate with the best score, else the one with the keyword, else ambiguous."""
    best = df.groupBy(group).agg(F.max(score).alias("__top"))
    seen = df.join(best, group).groupBy(group).agg(
        F.count_if(F.col(score) == F.col("__top")).alias("n"), F.min(F.when(F.col(score) == F.col("__top"), F.col(name))).alias("top"), F.count_if(keyword).alias("k"), F.min(F.when(keyword, F.col(name))).alias("word")
    )
    outcome = F.when(F.col("n") == 1, "scored").when(F.col("k") == 1, "keyword").otherwise("ambiguous")
    return seen.select(group, outcome.alias("outcome"), F.when(F.col("n") == 1, F.col("top")).when(F.col("k") == 1, F.col("word")).alias("choice"))


def unique_index(mirrors: DataFrame, identity: str, place: str) -> DataFrame:
    """Rows (identity, place, outcome): a mirror's place for each identity; one that several places claim is a conflict."""
    by = mirrors.where(F.col(identity).isNotNull()).groupBy(identity).agg(F.count("*").alias("__n"), F.min(place).alias("__p"))
    return by.select(identity, F.when(F.col("__n") == 1, F.col("__p")).alias(place), F.when(F.col("__n") == 1, "indexed").otherwise("conflict").alias("outcome"))


def merged_owners(maps: DataFrame, source: str, owner: str, priority: str) -> DataFrame:
    """Rows (source, owner, outcome) of several owner maps together; a source with two owners is rejected, else the map of first priority names it."""
    by = maps.groupBy(source).agg(F.min(owner).alias("lo"), F.max(owner).alias("hi"), F.min_by(owner, priority).alias("first"))
    clash = F.col("lo") != F.col("hi")
    return by.select(source, F.when(~clash, F.col("first")).alias(owner), F.when(clash, "rejected").otherwise("owned").alias("outcome"))


#: A key with at least this share of the rows is a hot one: there are at most 1 / HOT of them.
HOT = 0.001


def look_up(rows: DataFrame, on: str, facts: DataFrame, key: str) -> DataFrame:
    """``rows`` with the columns of their fact (nulls without one); ``facts`` has each key once.

    The facts of keys with a thousandth of the rows or more, at most a thousand, are
    broadcast; their rows get a salted key that meets nothing in the join of the
    others. So a key that a third of the rows share costs no more than others.
    """
    total = rows.count()
    hot = rows.where(F.col(on).isNotNull()).groupBy(F.col(on).alias(key)).agg(F.count("*").alias("__n")).where(F.col("__n") >= max(2, HOT * total)).select(key)
    values = [c for c in facts.columns if c != key]
    hot_facts = F.broadcast(facts.join(F.broadcast(hot), key).select(F.col(key).alias("__hot_key"), F.struct(*values).alias("__hot")))
    marked = rows.join(hot_facts, F.col(on) == F.col("__hot_key"), "left")
    # a hash of the whole row spreads rows that need no join, those without a key too
    spread = F.struct(F.lit(None).cast(rows.schema[on].dataType).alias("k"), F.xxhash64(*rows.columns).alias("salt"))
    join_key = F.when(F.col("__hot").isNotNull() | F.col(on).isNull(), spread).otherwise(F.struct(F.col(on).alias("k"), F.lit(0).cast("long").alias("salt")))
    cold = facts.select(F.struct(F.col(key).alias("k"), F.lit(0).cast("long").alias("salt")).alias("__key"), F.struct(*values).alias("__cold"))
    both = marked.withColumn("__key", join_key).join(cold, "__key", "left").withColumn("__fact", F.coalesce("__hot", "__cold"))
    return both.select(*rows.columns, *(F.col("__fact")[c].alias(c) for c in values))
