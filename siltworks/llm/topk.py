"""Exact top-k by Hamming distance with multi-index hashing.

A binary code is cut into m segments of 16 bits. A code at distance m * r + j
from a query (j < m) differs from it by at most r bits in one of the segments
0..j, or by less than r in one of the others. Round r looks up the keys that
differ by exactly r bits from each of a query's segments, leaves out segments
that the distance of its k-th neighbour so far does not ask for, and verifies
what it meets on whole codes. A query ends when no segment asks for the next
radius: then all codes as near as its k-th neighbour have been met.
"""

from __future__ import annotations

from functools import reduce
from itertools import combinations
from operator import add

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siltworks.llm.shared import keep

#: Bits of a segment, and segments of a 64-bit word.
WIDTH = 16
IN_WORD = 64 // WIDTH


def sign_code(vector: Column, words: int) -> list[Column]:
    """The code of a vector as 64-bit words: bit i is set where component i is positive; missing, null and NaN ones are not."""
    nothing, one = F.lit(0).cast("long"), F.lit(1).cast("long")
    positive = F.transform(vector, lambda x, i: F.when((x > 0) & ~F.isnan(x), F.call_function("shiftleft", one, F.pmod(i, F.lit(64)))).otherwise(nothing))
    word = lambda w: F.aggregate(F.slice(positive, 64 * w + 1, 64), nothing, lambda a, b: a.bitwiseOR(b))
    return [word(w).alias(f"c{w}") for w in range(words)]


def flips(radius: int) -> Column:
    """A constant array of the segment values with ``radius`` bits set."""
    return F.split(F.lit(",".join(str(sum(1 << b for b in c)) for c in combinations(range(WIDTH), radius))), ",").cast("array<int>")


def segment(word: Column, s: int) -> Column:
    """Segment ``s`` of a code, of which ``word`` is the 64-bit word that holds it."""
    return F.shiftrightunsigned(word, s % IN_WORD * WIDTH).bitwiseAND(F.lit((1 << WIDTH) - 1)).cast("int")


def first(df: DataFrame, n: int, by: list[str], *order: str) -> DataFrame:
    """The first ``n`` rows of each group, numbered by ``rank``; Spark keeps n rows of a group in each task before the shuffle."""
    return df.withColumn("rank", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where(F.col("rank") <= n)


def search(rows: DataFrame, k: int = 10, query_modulus: int = 50, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """The ``k`` nearest other rows of each row whose id is divisible by ``query_modulus``.

    Rows (query_id, neighbour_id, rank, distance) by Hamming distance of the sign
    codes, equal distances by id. A null or empty vector, or a null id, is neither
    query nor neighbour; null and NaN components are not positive, nor are those
    that a shorter vector lacks. Repeated rows are neighbours each; of several
    vectors of a query's id the smallest code asks, and none of them is its
    neighbour. Fewer than ``k`` other rows give fewer results.
    """
    usable = rows.where(F.col(id_col).isNotNull() & (F.size(vector_col) > 0)).select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("v"))
    words = -(-(usable.agg(F.max(F.size("v"))).first()[0] or 1) // 64)
    code, found = [f"c{w}" for w in range(words)], [f"f{w}" for w in range(words)]
    segments = words * IN_WORD
    coded = usable.select("id", *sign_code(F.col("v"), words))

    def segment_keys(names: list[str]) -> Column:
        return F.posexplode(F.array(*(segment(F.col(names[s // IN_WORD]), s) for s in range(segments))))

    # rows with equal codes are equally far from anything: k + 1 of their ids are enough (one may be the query)
    codes = first(coded, k + 1, code, "id").groupBy(*code).agg(F.sort_array(F.collect_list("id")).alias("ids"))
    index = keep(codes.select(*(F.col(c).alias(f) for c, f in zip(code, found)), "ids").select(*found, "ids", segment_keys(found).alias("segment", "key")), "code-index")
    queries = coded.where(F.pmod("id", F.lit(query_modulus)) == 0).groupBy("id").agg(F.min(F.struct(*code)).alias("code"))
    open_queries = keep(queries.select("id", "code.*", F.lit(64 * words).alias("bound")), "open-queries")

    xor = [F.col(c).bitwiseXOR(F.col(f)) for c, f in zip(code, found)]
    distance = reduce(add, [F.bit_count(x) for x in xor])
    apart = [F.bit_count(segment(xor[s // IN_WORD], s)) for s in range(segments)]
    seen, done = None, []
    for radius in range(WIDTH + 1):
        probes = open_queries.select("id", *code, "bound", segment_keys(code).alias("segment", "at")).where(F.col("segment") + segments * radius <= F.col("bound"))
        probes = probes.withColumn("key", F.explode(flips(radius))).withColumn("key", F.col("key").bitwiseXOR(F.col("at"))).drop("at")
        # both sides are shuffled by key: neither has a proven bound
        hits = probes.join(index.hint("merge"), ["segment", "key"])
        # a code is met in each segment that is near enough; the first round and segment to meet it reports it
        known = F.lit(False)
        for s, d in enumerate(apart):
            known = known | (d < radius) | ((d == radius) & (F.lit(s) < F.col("segment")))
        hits = hits.where(~known & (distance <= F.col("bound"))).select("id", distance.cast("long").alias("distance"), "ids")
        flat = hits.select("id", "distance", F.explode("ids").alias("neighbour")).where("neighbour <> id")
        if seen is not None:
            flat = flat.unionByName(seen.select("id", "distance", "neighbour"))
        now = keep(first(flat, k, ["id"], "distance", "neighbour"), "topk")
        kth = now.where(F.col("rank") == k).select("id", F.col("distance").cast("int").alias("kth"))
        rest = open_queries.join(kth, "id", "left").select("id", *code, F.least("bound", "kth").alias("bound"))
        rest = keep(rest.where(F.col("bound") >= segments * (radius + 1)), "open-queries")
        done.append(now.join(rest.select("id"), "id", "left_anti"))
        open_queries, seen = rest, now.join(rest.select("id"), "id", "left_semi")
        if radius == WIDTH or rest.isEmpty():
            break
    out = reduce(DataFrame.unionByName, done)
    return out.select(F.col("id").alias("query_id"), F.col("neighbour").alias("neighbour_id"), F.col("rank").cast("long").alias("rank"), "distance")


ORACLE = """
WITH v AS (SELECT vec_id AS id, embedding AS e FROM embeddings WHERE vec_id IS NOT NULL AND len(embedding) > 0),
d AS (SELECT q.id AS query_id, n.id AS neighbour_id,
             CAST(list_sum(list_transform(list_zip(q.e, n.e), lambda p: CASE WHEN (coalesce(p[1], 0) > 0) <> (coalesce(p[2], 0) > 0) THEN 1 ELSE 0 END)) AS BIGINT) AS distance
      FROM v q JOIN v n ON q.id % 50 = 0 AND q.id <> n.id),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, neighbour_id) AS rank FROM d)
SELECT query_id, neighbour_id, rank, distance FROM r WHERE rank <= 10
"""
