"""Quality classifier: a generalised additive model with pairwise interactions.

Features are counts and shares over the whole text. Each feature has a look-up
table over its bins and chosen pairs of features have a table over coarser
bins. Boosting goes round the tables in turn: a shallow tree over one table's
bins takes a small step down the log loss. A score is the logistic function of
the sum of the table entries that a document's bins name.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass, field
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Labelled rows the model is fitted on at most: those with the smallest hash of doc_id.
TRAINING_ROWS = 20_000
#: Bins of a feature, bins of a feature in a pair, pairs, rounds over all tables, step size, leaves of a tree.
BINS, PAIR_BINS, PAIRS, ROUNDS, STEP, LEAVES = 32, 8, 6, 120, 0.2, 4

FEATURES = (
    "log_words", "word_length", "distinct_words", "repeated_next", "upper", "letters", "digits", "symbols", "exclaims", "bars", "stops", "line_words", "distinct_lines", "long_words", "top_word",
)
SYMBOLS = re.compile(r"[^\w\s.,;:!?'\"()|-]")


def features(text: str | None) -> list[float]:
    """The features of a text; all zero for a null, empty or blank one."""
    words = text.split() if text else []
    if not words:
        return [0.0] * len(FEATURES)
    n, chars = len(words), len(text)
    counts: dict[str, int] = {}
    for w in words:
        counts[w] = counts.get(w, 0) + 1
    lines = [x for x in text.split("\n") if x]
    ascii_text = text.encode()
    letters = sum(map(len, words))
    upper = sum(1 for w in words if w[:2].isupper() and len(w) > 1)
    digits = sum(ascii_text.count(d) for d in (b"0", b"1", b"2", b"3", b"4", b"5", b"6", b"7", b"8", b"9"))
    symbols = len(SYMBOLS.findall(text))
    return [
        math.log1p(n), letters / n, len(counts) / n, sum(map(str.__eq__, words, words[1:])) / n, upper / n, letters / chars, digits / chars, symbols / n,
        text.count("!") / n, text.count("|") / n, text.count(". ") / n, n / max(1, len(lines)), len(set(lines)) / max(1, len(lines)),
        sum(1 for w in counts if len(w) > 14) / n, max(counts.values()) / n,
    ]


@dataclass
class Model:
    """Bin edges and look-up tables; ``tables`` are by feature, ``pair_tables`` by pair of features."""

    base: float = 0.0
    edges: list[np.ndarray] = field(default_factory=list)
    pair_edges: list[np.ndarray] = field(default_factory=list)
    tables: list[np.ndarray] = field(default_factory=list)
    pairs: list[tuple[int, int]] = field(default_factory=list)
    pair_tables: list[np.ndarray] = field(default_factory=list)

    def score(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.base)
        for j, (edges, table) in enumerate(zip(self.edges, self.tables, strict=True)):
            total += table[np.searchsorted(edges, x[:, j], side="right")]
        for (i, j), table in zip(self.pairs, self.pair_tables, strict=True):
            total += table[np.searchsorted(self.pair_edges[i], x[:, i], side="right"), np.searchsorted(self.pair_edges[j], x[:, j], side="right")]
        return 1 / (1 + np.exp(-np.clip(total, -30, 30)))


def cut_points(column: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(column, np.linspace(0, 1, bins + 1)[1:-1]))


def tree_steps(gradient: np.ndarray, weight: np.ndarray, leaves: int) -> np.ndarray:
    """The step for each bin of a shallow tree over ordered bins: best splits first."""
    g, h = np.concatenate([[0], np.cumsum(gradient)]), np.concatenate([[0], np.cumsum(weight)])
    worth = lambda a, b: (g[b] - g[a]) ** 2 / (h[b] - h[a] + 1.0)
    ends = [0, len(gradient)]
    for _ in range(leaves - 1):
        gains = [(worth(a, m) + worth(m, b) - worth(a, b), m) for a, b in zip(ends, ends[1:]) for m in range(a + 1, b) if min(h[m] - h[a], h[b] - h[m]) > 0.5]
        gain, at = max(gains, default=(0, 0))
        if gain <= 1e-9:
            break
        ends = sorted([*ends, at])
    out = np.empty(len(gradient))
    for a, b in zip(ends, ends[1:]):
        out[a:b] = (g[b] - g[a]) / (h[b] - h[a] + 1.0)
    return out


def pair_steps(gradient: np.ndarray, weight: np.ndarray, leaves: int) -> np.ndarray:
    """The step for each cell of a shallow tree over two binned features: best splits along either first."""
    g, h = (np.pad(x.cumsum(0).cumsum(1), ((1, 0), (1, 0))).tolist() for x in (gradient, weight))
    inside = lambda t, a, b, c, d: t[b][d] - t[a][d] - t[b][c] + t[a][c]
    worth = lambda r: inside(g, *r) ** 2 / (inside(h, *r) + 1.0)
    parts = [(0, gradient.shape[0], 0, gradient.shape[1])]
    for _ in range(leaves - 1):
        splits = []
        for part in parts:
            a, b, c, d = part
            cuts = [((a, m, c, d), (m, b, c, d)) for m in range(a + 1, b)] + [((a, b, c, m), (a, b, m, d)) for m in range(c + 1, d)]
            splits += [(worth(x) + worth(y) - worth(part), part, x, y) for x, y in cuts if min(inside(h, *x), inside(h, *y)) > 0.5]
        gain, part, *halves = max(splits, default=(0, None))
        if gain <= 1e-9:
            break
        parts = [p for p in parts if p != part] + halves
    out = np.empty(gradient.shape)
    for a, b, c, d in parts:
        out[a:b, c:d] = inside(g, a, b, c, d) / (inside(h, a, b, c, d) + 1.0)
    return out


def fit(x: np.ndarray, y: np.ndarray) -> Model:
    """Fit by cyclic boosting: first the features, then the pairs that explain most of what is left."""
    model = Model()
    if not len(y):
        return model
    rate = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    model.base = float(np.log(rate / (1 - rate)))
    model.edges = [cut_points(x[:, j], BINS) for j in range(x.shape[1])]
    model.pair_edges = [cut_points(x[:, j], PAIR_BINS) for j in range(x.shape[1])]
    model.tables = [np.zeros(len(e) + 1) for e in model.edges]
    if y.min() == y.max():
        return model
    bins = [np.searchsorted(e, x[:, j], side="right") for j, e in enumerate(model.edges)]
    coarse = [np.searchsorted(e, x[:, j], side="right") for j, e in enumerate(model.pair_edges)]
    total = np.full(len(y), model.base)

    def residual():
        p = 1 / (1 + np.exp(-total))
        return y - p, p * (1 - p)

    for _ in range(ROUNDS):
        for j, table in enumerate(model.tables):
            gradient, weight = residual()
            step = STEP * tree_steps(np.bincount(bins[j], gradient, len(table)), np.bincount(bins[j], weight, len(table)), LEAVES)
            table += step
            total += step[bins[j]]
    gradient, weight = residual()
    cells = {(i, j): coarse[i] * (len(model.pair_edges[j]) + 1) + coarse[j] for i, j in combinations(range(x.shape[1]), 2)}
    size = lambda i, j: (len(model.pair_edges[i]) + 1) * (len(model.pair_edges[j]) + 1)
    gain = {k: float((np.bincount(c, gradient, size(*k)) ** 2 / (np.bincount(c, weight, size(*k)) + 1)).sum()) for k, c in cells.items()}
    model.pairs = sorted(sorted(gain), key=lambda k: -gain[k])[:PAIRS]
    flat = [np.zeros(size(*k)) for k in model.pairs]
    for _ in range(ROUNDS // 2):
        for k, table in zip(model.pairs, flat, strict=True):
            gradient, weight = residual()
            g, h = np.bincount(cells[k], gradient, len(table)), np.bincount(cells[k], weight, len(table))
            grid = (len(model.pair_edges[k[0]]) + 1, -1)
            step = STEP * pair_steps(g.reshape(grid), h.reshape(grid), LEAVES).ravel()
            table += step
            total += step[cells[k]]
    model.pair_tables = [t.reshape(len(model.pair_edges[i]) + 1, -1) for (i, _), t in zip(model.pairs, flat, strict=True)]
    return model


def with_features(docs: DataFrame) -> DataFrame:
    """Rows (doc_id, x) for rows (doc_id, text)."""

    def run(batches):
        for b in batches:
            x = pa.array([features(t.as_py()) for t in b.column(1)], pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([b.column(0), x], ["doc_id", "x"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, x array<double>")


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(3)) == 1, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, rows: int = TRAINING_ROWS) -> Model:
    """Fit on at most ``rows`` labelled documents that are not held out.

    Those with the smallest hash of doc_id are taken; of several labels of one
    document the smallest counts, null and other labels than 0 and 1 do not.
    Without labels every score is 0.5.
    """
    usable = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality"))
    usable = usable.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    usable = usable.groupBy("doc_id").agg(F.min("quality").alias("quality"))
    chosen = usable.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    sample = docs.join(F.broadcast(chosen), "doc_id")  # at most ``rows`` pairs of integers
    # repeated rows of a document count once
    found = with_features(sample).groupBy("doc_id").agg(F.min("x").alias("x")).join(F.broadcast(chosen), "doc_id").select("doc_id", "x", "quality").collect()
    found.sort(key=lambda r: r["doc_id"])
    x = np.array([r["x"] for r in found], dtype=float).reshape(-1, len(FEATURES))
    return fit(x, np.array([r["quality"] for r in found], dtype=float))


def score(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (doc_id, held_out, score, predicted), one for each row of ``docs``.

    Only the text is scored; a null text counts as empty and has a score too.
    Repeated rows and null ids (not held out) give a row each; other columns are
    not read.
    """
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    model = docs.sparkSession.sparkContext.broadcast(train(source, labels))

    def run(batches):
        for b in batches:
            x = np.array([features(t.as_py()) for t in b.column(1)], dtype=float).reshape(-1, len(FEATURES))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(model.value.score(x), pa.float64())], ["doc_id", "score"])

    scored = source.mapInArrow(run, "doc_id long, score double")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def filter_rows(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, whose text the model scores 0.5 or more."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index(text_col)

    def run(batches):
        for b in batches:
            x = np.array([features(t.as_py()) for t in b.column(at)], dtype=float).reshape(-1, len(FEATURES))
            yield b.filter(pa.array(shared.value.score(x) >= 0.5))

    return docs.mapInArrow(run, docs.schema)
