"""How filters overlap: packed bitmaps by partition, AND-NOT and popcount for each prefix subset.

A filter removes rows that fail it; applied left to right, what a filter removes
depends on the filters before it, but only on their set. So each task packs its
rows into NumPy bitsets (one for each filter and label; a part is a stretch of
whole words of them), takes the survivors of all ``2^k`` subsets of ``k`` filters
by one AND-NOT each and counts their bits by part. Those counts add up over
tasks; the report of all ``k!`` orders is derived from the sums.

Nulls: a null text counts as empty, a null part as the empty string. A null
doc_id has no label, and its text neither repeats another nor is repeated.
Repeated rows are rows of their own. Several labels of a doc_id: any 1 counts.
"""

from __future__ import annotations

import hashlib
import itertools
import math
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltworks.llm.shared import drop_kept, keep
from siltworks.llm.tokens import slices

#: Filters by letter, in bit order; E is judged over the whole table.
LETTERS = "ABCDE"
SPECIAL = b"#$%&*|"


def text_conditions(texts: pa.Array) -> np.ndarray:
    """Bits of the conditions A to D that each text meets (nulls count as empty)."""
    texts = pc.fill_null(texts, "")
    kind = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    ends = np.frombuffer(texts.buffers()[1], kind)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64) if len(texts) else np.zeros(1, np.int64)
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[ends[0] : ends[-1]]
    ends = ends - ends[0]
    within = lambda hits: np.diff(np.searchsorted(np.flatnonzero(hits), ends))
    upper = within((data >= ord("A")) & (data <= ord("Z")))
    special = within(np.isin(data, np.frombuffer(SPECIAL, np.uint8)))
    points = pc.utf8_length(texts).to_numpy(zero_copy_only=False).astype(np.int64)

    split = pc.ascii_split_whitespace(texts)
    counts = pc.list_value_length(split).to_numpy(zero_copy_only=False).astype(np.int64)
    coded = split.flatten().dictionary_encode()
    codes, of = coded.indices.to_numpy().astype(np.int64), np.repeat(np.arange(len(texts)), counts)
    empty = pc.index(coded.dictionary, pa.scalar("", coded.dictionary.type)).as_py()
    real = codes != empty
    codes, of = codes[real], of[real]
    words = np.bincount(of, minlength=len(texts))
    different = np.bincount(np.unique(of * max(len(coded.dictionary), 1) + codes) // max(len(coded.dictionary), 1), minlength=len(texts))
    return (words < 50) + 2 * (100 * different < 65 * words) + 4 * (100 * upper > 5 * points) + 8 * (special > 0)


def document_conditions(docs: DataFrame, part: str = "source", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (doc_id, part, fails, digest): the conditions A to D of each text, and its SHA-256."""

    def judge(batches):
        for b in batches:
            for s in slices(b, 2):
                texts = pc.fill_null(s.column(2), "")
                digests = [hashlib.sha256(t.as_buffer()).digest() for t in texts]
                yield pa.RecordBatch.from_arrays([s.column(0), s.column(1), pa.array(text_conditions(texts), pa.int32()), pa.array(digests, pa.binary())], ["doc_id", "part", "fails", "digest"])

    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(part), F.lit("")).alias("part"), F.col(text_col).alias("text"))
    return source.mapInArrow(judge, "doc_id long, part string, fails int, digest binary")


def with_repeats(rows: DataFrame, bit: int) -> DataFrame:
    """Adds ``bit`` to ``fails`` where a smaller doc_id has the same digest.

    The first doc_id of each digest is a grouped minimum, and rows find it by
    (doc_id, digest), so a large group of copies is never gathered.
    """
    known = rows.where("doc_id is not null")
    first = known.groupBy("digest").agg(F.min("doc_id").alias("doc_id")).withColumn("__first", F.lit(True))
    marked = known.join(first, ["doc_id", "digest"], "left")
    fails = F.col("fails") + F.when(F.col("__first").isNull(), bit).otherwise(0)
    return marked.select("doc_id", "part", fails.alias("fails")).unionByName(rows.where("doc_id is null").select("doc_id", "part", "fails"))


def with_marks(rows: DataFrame, labels: DataFrame, *columns: str, id_col: str = "doc_id") -> DataFrame:
    """Adds ``marks``: a bit for each label column that is 1."""
    bits = sum(((F.max(F.when(F.col(c) == 1, 1).otherwise(0)) * (1 << i)) for i, c in enumerate(columns)), F.lit(0))
    marks = labels.where(F.col(id_col).isNotNull()).groupBy(F.col(id_col).cast("long").alias("doc_id")).agg(bits.cast("int").alias("marks"))
    known = rows.where("doc_id is not null").join(marks.where("marks > 0"), "doc_id", "left")
    return known.select("part", "fails", F.coalesce("marks", F.lit(0)).alias("marks")).unionByName(rows.where("doc_id is null").select("part", "fails", F.lit(0).alias("marks")))


def survivors(codes: np.ndarray, fails: np.ndarray, marks: np.ndarray, filters: int, labels: int) -> np.ndarray:
    """Counts [subset, part, 1 + labels] of rows that pass every filter of the subset; ``codes`` number the parts from 0."""
    sizes = np.bincount(codes)
    words = -(-sizes // 64)
    starts = np.cumsum(words) - words
    order = np.argsort(codes, kind="stable")
    place = np.empty(len(codes), np.int64)
    # rows of a part stand one after the other, from a word of their own
    place[order] = np.arange(len(codes)) + np.repeat(starts * 64 - (np.cumsum(sizes) - sizes), sizes)

    def packed(mask):
        bits = np.zeros(int(words.sum()) * 64, np.uint8)
        bits[place[mask]] = 1
        return np.packbits(bits).view(np.uint64)

    failed = [packed((fails >> k & 1).astype(bool)) for k in range(filters)]
    marked = [packed((marks >> k & 1).astype(bool)) for k in range(labels)]
    alive = [packed(np.ones(len(codes), bool))]
    out = np.empty((1 << filters, len(sizes), 1 + labels), np.int64)
    for subset in range(1 << filters):
        if subset:
            low = (subset & -subset).bit_length() - 1
            alive.append(alive[subset & (subset - 1)] & ~failed[low])
        for j, bits in enumerate([alive[subset], *(alive[subset] & m for m in marked)]):
            out[subset, :, j] = np.add.reduceat(np.bitwise_count(bits), starts, dtype=np.int64)
    return out


def subset_counts(rows: DataFrame, filters: int, labels: Sequence[str]) -> DataFrame:
    """Rows (part, subset, kept, one column a label) from rows (part, fails, marks); a row for each subset of each part."""
    names = ["kept", *labels]

    def count(batches):
        for b in batches:
            if b.num_rows:
                coded = b.column(0).dictionary_encode()
                found = survivors(*(c.to_numpy().astype(np.int64) for c in (coded.indices, b.column(1), b.column(2))), filters, len(labels))
                subset, part = np.divmod(np.arange(found.shape[0] * found.shape[1]), found.shape[1])
                columns = [coded.dictionary.take(pa.array(part)), pa.array(subset, pa.int32()), *(pa.array(found[:, :, j].ravel()) for j in range(len(names)))]
                yield pa.RecordBatch.from_arrays(columns, ["part", "subset", *names])

    made = rows.select("part", "fails", "marks").mapInArrow(count, "part string, subset int, " + ", ".join(f"{n} long" for n in names))
    return made.groupBy("part", "subset").agg(*(F.sum(n).alias(n) for n in names))


def order_report(counts: DataFrame, letters: str, labels: Sequence[str]) -> DataFrame:
    """One row for each part, order of the filters and step, from :func:`subset_counts`.

    ``k!`` orders make ``k * k!`` rows a part: 600 for five filters, 35,280 for seven.
    """
    k = len(letters)
    names, f, full = ["kept", *labels], F.col("filter"), (1 << k) - 1
    bit = F.element_at(F.array(*(F.lit(1 << i) for i in range(k))), f + 1)
    each = counts.withColumn("filter", F.explode(F.array(*(F.lit(i) for i in range(k))))).withColumn("bit", bit)
    inside = F.col("subset").bitwiseAND(F.col("bit")) > 0
    before = F.when(inside, F.col("subset") - F.col("bit")).otherwise(F.col("subset"))
    sums: list[Column] = []
    for n in names:
        sums += [F.sum(F.when(~inside, F.col(n)).otherwise(0)).alias(f"{n}_at"), F.sum(F.when(inside, F.col(n)).otherwise(0)).alias(f"{n}_after")]
    # 2^(k-1) * k rows a part
    cells = each.groupBy("part", "filter", "bit", before.alias("before")).agg(*sums).withColumn("removed", F.col("kept_at") - F.col("kept_after"))
    size = F.bit_count("before")
    weights = F.element_at(F.array(*(F.lit(math.factorial(i) * math.factorial(k - 1 - i)) for i in range(k))), size + 1)
    whole = cells.groupBy("part", "filter").agg(
        F.sum(F.when(F.col("before") == 0, F.col("removed")).otherwise(0)).alias("fails"),
        F.sum(F.when(F.col("before") == full - F.col("bit"), F.col("removed")).otherwise(0)).alias("unique_fails"),
        F.sum(F.col("removed") * weights).alias("shapley"),
    )
    steps = [("".join(o), s + 1, letters.index(o[s]), sum(1 << letters.index(c) for c in o[:s])) for o in itertools.permutations(letters) for s in range(k)]
    orders = counts.sparkSession.createDataFrame(steps, "filter_order string, step int, filter int, before int")
    lost = [(F.col(f"{n}_at") - F.col(f"{n}_after")).alias(f"{n}_lost") for n in labels]
    # the orders are k * k! rows whatever the data
    found = cells.join(whole, ["part", "filter"]).join(F.broadcast(orders), ["filter", "before"])
    return found.select("part", "filter_order", "step", F.col("kept_after").alias("kept"), "removed", (F.col("fails") - F.col("removed")).alias("redundant"), "unique_fails", *lost, "shapley")


def audit(docs: DataFrame, labels: DataFrame, part: str = "source", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The five filters' report over whole texts, for each part, order and step; see the module for nulls and repeats.

    An empty table has no part and gives no row.
    """
    judged = keep(document_conditions(docs, part, id_col, text_col), "filter-conditions")
    marked = with_marks(with_repeats(judged, 1 << LETTERS.index("E")), labels, "quality", "toxic", id_col=id_col)
    counts = keep(subset_counts(marked, len(LETTERS), ["good", "toxic"]), "filter-counts")
    drop_kept(judged)
    return order_report(counts, LETTERS, ["good", "toxic"])


ORACLE = r"""
WITH w AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
j AS (SELECT doc_id, part, (len(w) < 50)::INT + 2 * (100 * len(list_distinct(w)) < 65 * len(w))::INT + 4 * (100 * len(regexp_extract_all(t, '[A-Z]')) > 5 * length(t))::INT
  + 8 * regexp_matches(t, '[#$%&*|]')::INT + 16 * coalesce(doc_id > min(doc_id) OVER (PARTITION BY t), false)::INT AS fails FROM w),
l AS (SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic FROM labels GROUP BY doc_id),
m AS (SELECT part, fails, count(*) AS n, count(*) FILTER (WHERE good = 1) AS good, count(*) FILTER (WHERE toxic = 1) AS toxic FROM j LEFT JOIN l USING (doc_id) GROUP BY ALL),
c AS (SELECT part, s::INT AS s, sum(CASE WHEN fails & s = 0 THEN n ELSE 0 END) AS n, sum(CASE WHEN fails & s = 0 THEN good ELSE 0 END) AS good, sum(CASE WHEN fails & s = 0 THEN toxic ELSE 0 END) AS toxic
  FROM m, range(32) t(s) GROUP BY ALL),
f AS (SELECT i, 1 << i AS b, chr((65 + i)::INT) AS f FROM (SELECT unnest(range(5))::INT AS i)),
o AS (SELECT a.f || b.f || c.f || d.f || e.f AS filter_order FROM f a, f b, f c, f d, f e WHERE a.b + b.b + c.b + d.b + e.b = 31 AND len(list_distinct([a.i, b.i, c.i, d.i, e.i])) = 5),
p AS (SELECT filter_order, step, f.b AS b, coalesce(list_sum(list_transform(range(1, step), lambda k: 1 << (ascii(filter_order[k]) - 65))), 0)::INT AS s
  FROM o, (SELECT unnest(range(1, 6))::INT AS step), f WHERE f.f = filter_order[step]),
r AS (SELECT x.part, filter_order, step, p.b AS b, y.n AS kept, x.n - y.n AS removed, x.good - y.good AS good_lost, x.toxic - y.toxic AS toxic_lost FROM p JOIN c x ON x.s = p.s JOIN c y ON y.part = x.part AND y.s = p.s + p.b),
h AS (SELECT part, b, sum(removed) AS shapley, max(removed) FILTER (WHERE step = 1) AS fails, max(removed) FILTER (WHERE step = 5) AS unique_fails FROM r GROUP BY ALL)
SELECT part, filter_order, step, kept::BIGINT AS kept, removed::BIGINT AS removed, (fails - removed)::BIGINT AS redundant, unique_fails::BIGINT AS unique_fails,
  good_lost::BIGINT AS good_lost, toxic_lost::BIGINT AS toxic_lost, shapley::BIGINT AS shapley FROM r JOIN h USING (part, b)
"""
