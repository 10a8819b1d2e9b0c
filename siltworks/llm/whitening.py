"""Whitening of embeddings from an exact covariance: digit-slice GEMM.

Entries become integers ``x = floor(scale * c) + shift``. With ``n`` rows and sums
``S`` by dimension, ``y = n * x - S`` is the centred vector times ``n``, an integer,
so the products of centred vectors are exact: each ``y`` is cut into limbs of
:data:`LIMB` bits with sign, the limbs' float64 BLAS products over at most
:data:`ROWS` rows stay below 2^53 and so are exact, and limbs of products come
together as big integers. Tasks emit their sums as digits that Spark adds up by
grouped sums; the ``d x d`` result, bounded by the dimension, goes to the driver
for the eigenvectors.

Rows whose vector is null, or has null or non-finite entries, are left out, and
so are those of another length than most (of equally frequent lengths, the
longer). Repeated rows and null ids count like others. Scaled entries beyond
``+-2^60`` are held there. A component without variance has no whitened value
(null) and explains 0; a deviation that no long holds is null. An empty table
gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bits of a limb, and rows that one product spans: 2 * (LIMB - 1) + log2(ROWS) < 53.
LIMB, ROWS = 21, 4096
#: Bits of the digits that Spark adds up: sums of up to 2^23 tasks fit a long.
DIGIT = 40


def finite(df: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """Rows (vec_id, vector, width) whose entries are all finite numbers."""
    vector = F.col(vector_col).cast("array<double>")
    good = F.forall("vector", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(math.inf)))
    rows = df.select(F.col(id_col).alias("vec_id"), vector.alias("vector")).where("vector is not null and size(vector) > 0").where(good)
    return rows.withColumn("width", F.size("vector"))


def blocks(batches: Iterator[pa.RecordBatch], column: int, scale: int, shift: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Stretches of at most ROWS rows with their integers, one row a vector."""
    for b in batches:
        for at in range(0, b.num_rows, ROWS):
            s = b.slice(at, ROWS)
            values = s.column(column).flatten().to_numpy(zero_copy_only=False).reshape(s.num_rows, -1)
            with np.errstate(over="ignore"):
                yield s, np.clip(np.floor(scale * values), -(2.0**60), 2.0**60).astype(np.int64) + shift


def digits(number: int) -> Iterator[tuple[int, int]]:
    """(place, digit) of an integer in base 2^DIGIT, digits signed as the number."""
    sign, rest, place = (-1 if number < 0 else 1), abs(number), 0
    while rest:
        yield place, sign * (rest & (1 << DIGIT) - 1)
        rest, place = rest >> DIGIT, place + 1


def added(rows: DataFrame) -> dict[tuple[int, int], int]:
    """Exact sums by (i, j) of rows (i, j, place, digit)."""
    out: dict[tuple[int, int], int] = {}
    for r in rows.groupBy("i", "j", "place").agg(F.sum("digit").alias("digit")).collect():
        out[r.i, r.j] = out.get((r.i, r.j), 0) + (r.digit << DIGIT * r.place)
    return out


def digit_batch(sums: dict[tuple[int, int], int]) -> pa.RecordBatch:
    rows = [(i, j, place, digit) for (i, j), v in sums.items() for place, digit in digits(v)]
    columns = list(zip(*rows, strict=True)) or [(), (), (), ()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int32(), pa.int32(), pa.int32(), pa.int64()), strict=True)], ["i", "j", "place", "digit"])


DIGITS = "i int, j int, place int, digit long"


def centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """``n * x - sums``: 64-bit integers, or Python's where those could overflow."""
    near = [s // n for s in sums]  # x - near is small, whatever the shift
    base, rest = x - np.array(near, np.int64), [s - n * c for s, c in zip(sums, near, strict=True)]
    if n * (int(np.abs(base).max(initial=0)) + 1) < 1 << 62:
        return base * n - np.array(rest, np.int64)
    return base.astype(object) * n - np.array(rest, object)


def product(y: np.ndarray) -> np.ndarray:
    """``y.T @ y`` of integers (at most ROWS rows), exact, as Python integers."""
    limbs, rest = [], y
    while np.any(rest):
        low = (rest + (1 << LIMB - 1) & (1 << LIMB) - 1) - (1 << LIMB - 1)
        limbs.append(low.astype(np.float64))
        rest = rest - low >> LIMB
    total = np.zeros((y.shape[1], y.shape[1]), object)
    for i, a in enumerate(limbs):
        for j, b in enumerate(limbs[i:], i):
            part = (a.T @ b).astype(np.int64).astype(object)
            total += (part if i == j else part + part.T) << LIMB * (i + j)
    return total


def wide(number: int, by: int) -> np.longdouble:
    """``number / by`` in extended precision."""
    high = number / by
    a, b = high.as_integer_ratio()
    return np.longdouble(high) + np.longdouble((number * b - a * by) / (by * b))


def eigenvectors(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and unit eigenvectors (columns) of a symmetric matrix, refined in extended precision."""
    start = np.linalg.eigh(v.astype(np.float64))[1][:, ::-1].astype(np.longdouble)
    for _ in range(2):
        start = start @ (3 * np.eye(len(v), dtype=np.longdouble) - start.T @ start) / 2
    m, turned = start.T @ v @ start, start
    tiny = np.finfo(np.longdouble).eps
    for _ in range(10):  # cyclic rotations; an almost diagonal matrix needs two or three sweeps
        done = True
        for p in range(len(v) - 1):
            for q in p + 1 + np.flatnonzero(np.abs(m[p, p + 1 :]) > tiny * np.sqrt(np.abs(m[p, p] * np.diagonal(m)[p + 1 :])) / 4 + tiny * tiny):
                if abs(m[p, q]) <= tiny * np.sqrt(abs(m[p, p] * m[q, q])) / 4:
                    continue
                done = False
                half = (m[q, q] - m[p, p]) / (2 * m[p, q])
                t = (1 if half >= 0 else -1) / (abs(half) + np.sqrt(half * half + 1))
                c = 1 / np.sqrt(t * t + 1)
                turn = np.array([[c, t * c], [-t * c, c]])
                m[:, [p, q]] = m[:, [p, q]] @ turn
                m[[p, q], :] = turn.T @ m[[p, q], :]
                turned[:, [p, q]] = turned[:, [p, q]] @ turn
        if done:
            break
    order = np.argsort(-np.diagonal(m), kind="stable")
    return np.diagonal(m)[order], turned[:, order] / np.sqrt((turned[:, order] ** 2).sum(axis=0))


@dataclass
class Whitening:
    """A fitted whitening; its size depends on the dimension alone."""

    n: int
    width: int
    sums: list[int]
    scale: int
    shift: int
    #: Eigenvalues over the trace, columns of eigenvectors over the square roots of the eigenvalues, and which have variance.
    explained: np.ndarray
    turn: np.ndarray
    varies: np.ndarray
    identity_error: float = 0.0

    def centre(self, x: np.ndarray) -> np.ndarray:
        return centred(x, self.n, self.sums)

    def project(self, y: np.ndarray) -> np.ndarray:
        return (y / self.n).astype(np.float64) @ self.turn


def covariance(rows: DataFrame, width: int, scale: int, shift: int) -> tuple[int, list[int], dict[tuple[int, int], int]]:
    """n, sums by dimension, and the exact sums of products of ``n * x - S``, from rows (vector)."""

    def add(batches):
        n, total = 0, None
        for _, x in blocks(batches, 0, scale, shift):
            n += len(x)
            # ROWS entries below 2^61 in halves, so that no sum overflows
            part = (x >> 31).sum(axis=0).astype(object) * (1 << 31) + (x & (1 << 31) - 1).sum(axis=0).astype(object)
            total = part if total is None else total + part
        if n:
            yield digit_batch({(-1, 0): n} | {(i, 0): int(v) for i, v in enumerate(total)})

    found = added(rows.mapInArrow(add, DIGITS))
    n = found.pop((-1, 0), 0)
    sums = [found.get((i, 0), 0) for i in range(width)]

    def multiply(batches):
        total = None
        for _, x in blocks(batches, 0, scale, shift):
            part = product(centred(x, n, sums))
            total = part if total is None else total + part
        if total is not None:
            yield digit_batch({(i, j): int(total[i, j]) for i in range(width) for j in range(i, width)})

    return n, sums, added(rows.mapInArrow(multiply, DIGITS)) if n else {}


def fit(rows: DataFrame, width: int, components: int, scale: int, shift: int) -> Whitening | None:
    """The whitening of rows (vector) of one width; None where there is no row."""
    n, sums, products = covariance(rows, width, scale, shift)
    if not n:
        return None
    d = width
    v = np.zeros((d, d), np.longdouble)
    for (i, j), value in products.items():
        v[i, j] = v[j, i] = wide(value, n**3)
    values, vectors = eigenvectors(v)
    values, vectors, trace = values[:components], vectors[:, :components], np.trace(v)
    varies = values > trace * d * np.longdouble(2) ** -60
    root = np.sqrt(np.where(varies, values, 1))
    explained = np.where(varies, values / (trace if trace > 0 else 1), 0).astype(np.float64)
    model = Whitening(n, d, sums, scale, shift, explained, (vectors / root).astype(np.float64), varies)
    model.identity_error = identity_error(rows, model)
    return model


def identity_error(rows: DataFrame, model: Whitening) -> float:
    """The largest entry of the whitened rows' covariance less the identity, over components with variance."""
    k = int(model.varies.sum())

    def add(batches):
        total, first = np.zeros((k, k)), np.zeros(k)
        for _, x in blocks(batches, 0, model.scale, model.shift):
            w = model.project(model.centre(x))[:, :k]  # of exactly centred rows
            total, first = total + w.T @ w, first + w.sum(axis=0)
        i, j = np.triu_indices(k)
        columns = [np.concatenate([i, np.arange(k)]), np.concatenate([j, np.full(k, -1)]), np.concatenate([total[i, j], first])]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int32(), pa.int32(), pa.float64()), strict=True)], ["i", "j", "v"])

    found, mean = np.zeros((k, k)), np.zeros(k)
    for r in rows.mapInArrow(add, "i int, j int, v double").groupBy("i", "j").agg(F.sum("v").alias("v")).collect() if k else ():
        if r.j < 0:
            mean[r.i] = r.v / model.n
        else:
            found[r.i, r.j] = found[r.j, r.i] = r.v / model.n
    return float(np.abs(found - np.outer(mean, mean) - np.eye(k)).max()) if k else 0.0


def whiten(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = 32, scale: int = 64, shift: int = 1_000_000) -> DataFrame:
    """Rows (vec_id, component, n, deviation, whitened, explained, identity_error), one for each vector and component."""
    spark = df.sparkSession
    rows = finite(df, id_col, vector_col)
    kind = rows.schema["vec_id"].dataType.simpleString()
    schema = f"vec_id {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    usual = rows.groupBy("width").count().orderBy(F.desc("count"), F.desc("width")).first()
    if usual is not None:
        rows = rows.where(F.col("width") == usual.width)
    model = fit(rows.select("vector"), usual.width, components, scale, shift) if usual is not None else None
    if model is None:
        return spark.createDataFrame([], schema)

    def score(batches):
        k = len(model.explained)
        for s, x in blocks(batches, 1, scale, shift):
            y = model.centre(x)
            small = y.dtype != object and model.width * int(np.abs(y).max(initial=0)) ** 2 < 1 << 62
            exact = (y * y).sum(axis=1) if small else [v if v < 1 << 63 else None for v in (y.astype(object) ** 2).sum(axis=1)]
            each = np.repeat(np.arange(len(x)), k)
            values = pa.array(model.project(y).ravel(), mask=~np.tile(model.varies, len(x)))
            constant = lambda v, t: pa.array(np.full(len(each), v), t)
            columns = [
                s.column(0).take(pa.array(each)), pa.array(np.tile(np.arange(1, k + 1), len(x)), pa.int32()), constant(model.n, pa.int64()), pa.array(exact, pa.int64()).take(pa.array(each)),
                values, pa.array(np.tile(model.explained, len(x))), constant(model.identity_error, pa.float64()),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return rows.select("vec_id", "vector").mapInArrow(score, schema)
