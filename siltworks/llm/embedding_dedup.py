"""Near-duplicate embeddings by PCA-ordered tiled comparison.

Vectors are compared inside a label only. Equal vectors are one class. Unit
vectors are turned so that leading dimensions hold most of the variance (the turn
is fitted on a bounded sample and changes no cosine). Each label is dealt into
tiles along the first three of them, one after the other, and two tiles meet only
if their boxes over the leading dimensions and the suffix norm are close enough
for the threshold. Boxes are compared from the coarse to the fine, so what lies
in boxes that are far apart is never paired. Inside a pair of tiles products
accumulate over leading dimensions first; what the rest can add is bounded by the
product of the suffix norms, and a pair is given up when that cannot reach the
threshold.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltworks.llm.shared import components, keep, stars

#: Vectors that the turn is fitted on at most; vectors in a tile; dimensions after which a bound is taken.
PCA_ROWS, TILE, STEPS = 10_000, 2048, (8, 16, 32)
#: Dimensions that tiles are cut along, and dimensions that their boxes have; the suffix norm is one more.
SPLITS, BOX = 3, 8
#: Tile numbers: cells along one dimension, hashed parts of a cell.
CELLS, PARTS = 1 << 12, 1 << 24
#: Rows of a tile that are compared at once.
STRIP = 512


def principal_axes(sample: np.ndarray) -> np.ndarray:
    """Orthogonal axes as columns, the one with most variance first."""
    _, vectors = np.linalg.eigh(np.cov(sample, rowvar=False, bias=True).reshape(sample.shape[1], -1))
    return vectors[:, ::-1]


def units(vectors: np.ndarray) -> np.ndarray:
    return vectors / np.linalg.norm(vectors, axis=1, keepdims=True)


def links(a: np.ndarray, b: np.ndarray, axes: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Positions (i, j) with cosine of ``a[i]`` and ``b[j]`` at or over the threshold."""
    ua, ub = units(a), units(b)
    ta, tb = ua @ axes, ub @ axes
    rest = lambda t, d: np.sqrt(np.maximum(0, (t[:, d:] ** 2).sum(axis=1)))
    slack, found = 1e-9, []
    for top in range(0, len(a), STRIP):
        rows, done = slice(top, top + STRIP), 0
        total = np.zeros((len(ta[rows]), len(tb)))
        i = j = None
        for d in [*(x for x in STEPS if x < axes.shape[1]), axes.shape[1]]:
            if i is None:
                total += ta[rows, done:d] @ tb[:, done:d].T
                open_pairs = total + rest(ta[rows], d)[:, None] * rest(tb, d)[None] >= threshold - slack
                if open_pairs.mean() < 0.05:
                    i, j = np.nonzero(open_pairs)
                    total = total[i, j]
            else:
                total = total + np.einsum("ij,ij->i", ta[rows][i, done:d], tb[j, done:d])
                stay = total + rest(ta[rows], d)[i] * rest(tb, d)[j] >= threshold - slack
                i, j, total = i[stay], j[stay], total[stay]
            done = d
        if i is None:
            i, j = np.nonzero(total >= threshold - slack)
        i = i + top
        # in double precision on the vectors as they are
        for s in range(0, len(i), 1 << 18):
            p, q = i[s : s + (1 << 18)], j[s : s + (1 << 18)]
            dot = np.einsum("ij,ij->i", a[p], b[q]) / (np.linalg.norm(a, axis=1)[p] * np.linalg.norm(b, axis=1)[q])
            sure = dot >= threshold
            found.append((p[sure], q[sure]))
    if not found:
        return np.empty(0, int), np.empty(0, int)
    return np.concatenate([x for x, _ in found]), np.concatenate([x for _, x in found])


def leading(vectors: np.ndarray, axes: np.ndarray) -> np.ndarray:
    """The first BOX coordinates of the unit vectors along the axes (0 beyond their number), then the norm of the rest."""
    turned = units(vectors) @ axes[:, :BOX]
    out = np.zeros((len(vectors), BOX + 1))
    out[:, : turned.shape[1]] = turned
    out[:, BOX] = np.sqrt(np.maximum(0, 1 - (turned**2).sum(axis=1)))
    return out


def tiled(led: DataFrame) -> DataFrame:
    """``led`` (label, d, lead, ...) with its place c0, c1, c2 along the leading dimensions.

    Places are quantile ranges inside those of the dimension before: their number
    grows with a label, their size does not. A cut table has one row for each cell
    of the dimensions before, so it stays far smaller than the vectors.
    """
    path = ["label", "d"]
    for k in range(SPLITS):
        place, at = f"c{k}", F.get("lead", F.lit(k))
        ways = F.ceil(F.pow(F.ceil(F.col("n") / TILE).cast("double"), F.lit(1 / (SPLITS - k))) - 1e-9).cast("int")
        most = led.groupBy(*path).agg(F.count("*").alias("n")).agg(F.max(ways)).first()[0] or 1
        if most == 1:
            led = led.withColumn(place, F.lit(0))
        else:
            grid = 4 * most
            found = led.groupBy(*path).agg(F.percentile_approx(at, [i / grid for i in range(1, grid)], 10_000).alias("grid"), F.count("*").alias("n")).withColumn("ways", ways)
            cut = lambda i: F.element_at("grid", F.greatest(F.lit(1), F.least(F.size("grid"), F.round(i * grid / F.col("ways")).cast("int"))))  # noqa: B023, E731
            cuts = F.when(F.col("ways") > 1, F.transform(F.sequence(F.lit(1), F.greatest(F.lit(1), F.col("ways") - 1)), cut)).otherwise(F.array().cast("array<double>"))
            led = led.join(found.select(*path, cuts.alias("cuts")), path).withColumn(place, F.size(F.filter("cuts", lambda c: c < at))).drop("cuts")  # noqa: B023
        path.append(place)
    return led


def near_cells(cells: DataFrame, threshold: float) -> DataFrame:
    """Pairs (label, d, xc0.., yc0..) of cells, in both orders and with themselves, whose boxes allow a cosine of ``threshold``.

    ``cells`` has a row (label, d, c0.., l0.., h0..) for each cell with the bounds of
    its box. The distance of unit vectors is bounded below by that of their boxes.
    Only cells of near coarser cells are paired.
    """
    path, bounds = ["label", "d", *(f"c{k}" for k in range(SPLITS))], range(BOX + 1)
    apart = lambda a: F.greatest(F.lit(0.0), F.col(f"xl{a}") - F.col(f"yh{a}"), F.col(f"yl{a}") - F.col(f"xh{a}"))
    close = sum((apart(a) * apart(a) for a in bounds), F.lit(0.0)) <= 2 - 2 * threshold + 1e-7
    near = None
    for k in range(SPLITS):
        boxes = cells.groupBy(*path[: k + 3]).agg(*(F.min(f"l{a}").alias(f"l{a}") for a in bounds), *(F.max(f"h{a}").alias(f"h{a}") for a in bounds))
        x, y = (boxes.select("label", "d", *(F.col(c).alias(side + c) for c in boxes.columns[2:])) for side in "xy")
        if near is None:
            near = x.join(y, ["label", "d"])
        else:
            near = near.join(x, ["label", "d", *(f"xc{i}" for i in range(k))]).join(y, ["label", "d", *(f"yc{i}" for i in range(k))])
        near = near.where(close).select("label", "d", *(f"{side}c{i}" for side in "xy" for i in range(k + 1)))
    return near


def near_duplicates(rows: DataFrame, threshold: float = 0.93, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """Rows (vec_id, n_links, component_id, kept), one for each row of ``rows``.

    Vectors link if their labels are equal and not null, their lengths are equal
    and their cosine is at least ``threshold``. Vectors that are null, empty or
    zero, or hold a null or non-finite component, link with nothing. component_id
    is the smallest vec_id reachable; kept is true where it is the row's own.
    Repeated rows link with each other; rows with one vec_id count as one node;
    a null vec_id is kept and links are counted for it.
    """
    spark = rows.sparkSession
    vector = F.transform(F.col(vector_col), lambda x: x.cast("double"))
    source = rows.select(F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).cast("string").alias("label"), vector.alias("v"))
    sound = F.col("label").isNotNull() & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("v", lambda x: x != 0)
    source = source.withColumn("v", F.when(sound, F.col("v")))
    hashed = lambda seed: F.when(F.col("v").isNotNull(), F.xxhash64("v", F.lit(seed)))
    source = keep(source.select("vec_id", "label", "v", hashed(1).alias("print1"), hashed(2).alias("print2")), "vectors")
    key = ["label", "print1", "print2"]
    classes = keep(source.where("v is not null").groupBy(*key).agg(F.min("vec_id").alias("rep"), F.count("*").alias("copies")), "classes")
    # one vector for each class; a class of null ids alone is told apart by its print
    node = F.coalesce("rep", F.col("print1"))
    distinct = source.where("v is not null").select(*key, "vec_id", "v").join(classes.select(*key, "rep", "copies"), key).where("vec_id <=> rep").dropDuplicates(key)
    distinct = distinct.select("label", F.size("v").alias("d"), node.alias("node"), "copies", "v")

    sample = distinct.select("d", "v").orderBy(F.xxhash64("node"), "node").limit(PCA_ROWS).collect()
    axes = {}
    for d in {r["d"] for r in sample}:
        axes[d] = principal_axes(units(np.array([r["v"] for r in sample if r["d"] == d])))
    shared_axes = spark.sparkContext.broadcast(axes)

    def lead(batches):
        for b in batches:
            length, at = b.column(1).to_numpy(), np.zeros((b.num_rows, BOX + 1))
            for d, turn in shared_axes.value.items():
                if len(some := np.flatnonzero(length == d)):
                    at[some] = leading(b.column(4).take(pa.array(some)).flatten().to_numpy().reshape(-1, d), turn)
            ends = pa.array(np.arange(b.num_rows + 1, dtype=np.int32) * (BOX + 1))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.ListArray.from_arrays(ends, pa.array(at.ravel()))], [*b.schema.names, "lead"])

    led = keep(distinct.mapInArrow(lead, "label string, d int, node long, copies long, v array<double>, lead array<double>"), "led")
    dealt = tiled(led)
    path = ["label", "d", *(f"c{k}" for k in range(SPLITS))]
    ends = lambda f, name: (f(F.get("lead", F.lit(a))).alias(f"{name}{a}") for a in range(BOX + 1))
    cells = keep(dealt.groupBy(*path).agg(F.count("*").alias("n"), *ends(F.min, "l"), *ends(F.max, "h")), "cells")
    # equal places may fill a cell beyond its size: then it is dealt by hash as well
    number = F.lit(0).cast("long")
    for place in path[2:]:
        number = number * CELLS + F.col(place)
    known = cells.select(*path, number.alias("cell"), F.ceil(F.col("n") / (2 * TILE)).cast("int").alias("parts"))
    near = near_cells(cells, threshold)
    for side in "xy":
        near = near.join(known.select("label", "d", *(F.col(c).alias(side + c) for c in known.columns[2:])), ["label", "d", *(side + c for c in path[2:])])
    near = near.select("label", "d", *(F.col("x" + c).alias(c) for c in path[2:]), "xcell", "xparts", "ycell", "yparts")
    meets = dealt.join(near, path)
    mine = F.col("xcell") * PARTS + F.pmod(F.xxhash64("node"), F.col("xparts"))
    theirs = F.explode(F.transform(F.sequence(F.lit(0), F.col("yparts") - 1), lambda p: F.col("ycell") * PARTS + p))
    pairs = meets.select("label", "d", "node", "copies", "v", mine.alias("tile"), theirs.alias("with"))
    pairs = pairs.withColumns({"lo": F.least("tile", "with"), "hi": F.greatest("tile", "with")})

    def compare(tile: pa.Table) -> pa.Table:
        ids, copies, own = tile["node"].to_numpy(), tile["copies"].to_numpy(), tile["tile"].to_numpy()
        d = tile["d"][0].as_py()
        v = tile["v"].combine_chunks().flatten().to_numpy().reshape(-1, d)
        lo, hi = tile["lo"][0].as_py(), tile["hi"][0].as_py()
        rows_, cols = np.flatnonzero(own == lo), np.flatnonzero(own == hi)
        turn = shared_axes.value.get(d)
        i, j = links(v[rows_], v[cols], np.eye(d) if turn is None else turn, threshold)
        i, j = rows_[i], cols[j]
        if lo == hi:
            once = i < j
            i, j = i[once], j[once]
        counts = np.bincount(i, copies[j], len(ids)) + np.bincount(j, copies[i], len(ids))
        label = stars(i, j, len(ids))
        at = np.flatnonzero(counts > 0)
        return pa.table({"node": pa.array(ids[at], pa.int64()), "links": pa.array(counts[at].astype(np.int64)), "star": pa.array(ids[label[at]], pa.int64())})

    # dealt anew: rows that stand by label and range would put all pairs of one range into one task
    fields = pairs.repartition("label", "d", "lo", "hi").select("label", "d", "lo", "hi", "tile", "node", "copies", "v")
    found = keep(fields.groupBy("label", "d", "lo", "hi").applyInArrow(compare, "node long, links long, star long"), "links")
    counts = found.groupBy("node").agg(F.sum("links").alias("links"))
    linked = components(found.select(F.col("node").alias("a"), F.col("star").alias("b"))).select(F.col("id").alias("node"), "component")
    answer = classes.withColumn("node", node).join(counts, "node", "left").join(linked, "node", "left")
    answer = answer.select(*key, "rep", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("links"), F.coalesce("component", "rep").alias("component_id"))
    # two rows of one id are one node; its rows show their own class's links
    out = source.select("vec_id", *key).join(answer, key, "left")
    component = F.coalesce("component_id", "vec_id")
    return out.select(
        "vec_id", F.coalesce("links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept")
    )


ORACLE = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e FROM embeddings
  WHERE label IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id
      WHERE list_inner_product(a.e, b.e) / (sqrt(list_inner_product(a.e, a.e)) * sqrt(list_inner_product(b.e, b.e))) >= 0.93),
r AS (SELECT a, b FROM l UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a),
c AS (SELECT a, min(b) AS m FROM r GROUP BY a), n AS (SELECT a, count(*) AS n FROM l GROUP BY a)
SELECT e.vec_id, coalesce(n.n, 0) AS n_links, least(e.vec_id, coalesce(c.m, e.vec_id)) AS component_id, least(e.vec_id, coalesce(c.m, e.vec_id)) = e.vec_id AS kept
FROM embeddings e LEFT JOIN c ON c.a = e.vec_id LEFT JOIN n ON n.a = e.vec_id
"""
