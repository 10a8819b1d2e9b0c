"""Near-duplicate documents by bottom-k sketches of one hash function.

A document is the set of its word shingles, hashed once. Its sketch is the k
smallest hashes. Documents with equal sets are one class, and only one document
of a class goes on.

*Overlaps.* If two sets are as similar as the threshold asks, a sketch of one
shares at least ``share * k`` values with the sketch of the other (below by at
most five standard deviations of the sampling error; exact where a set fits its
sketch). So each sketch is ordered by rarity of its values, and two such sketches
must meet in the inverted list of one of their first ``k - share * k + 1`` values.
A document whose shared values are too few for that has no partner and drops out
before any list is read; a passage that many documents share is a small part of
each sketch and stays out of the lists.

*Groups.* Lists become groups by a star from each list's smallest document, so
a long list costs as many rows as it has documents. Every link lies in one group.
Groups are dealt into blocks of bounded size. A group that fills more than one is
first compared with a few of its own documents, its leaders: what a leader links
is one cell, and two documents of a cell need no comparison. Then each pair of
blocks that may still join two cells is one task unit. There the inverted lists of
sketch values give the overlaps, the estimate from the union of two sketches
filters candidates, and the exact Jaccard on the full sets confirms links. A large
group of near copies so costs as many comparisons as it has documents.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltworks.llm import url_filter
from siltworks.llm.shared import components, drop_kept, keep, stars
from siltworks.llm.tokens import distinct_chunks, joined, slices

#: Values in a sketch; shingles in a block of a group (bounds a task unit's memory); standard deviations of slack.
SKETCH, BLOCK, SLACK = 64, 100_000, 5
#: Leaders of a group of several blocks at most; what a document weighs in a block besides its shingles.
LEADERS, ROW = 16, 32
#: What fills the place of missing values in a sketch.
NO_VALUE = np.iinfo(np.int64).max


def shingle_sets(texts: pa.Array, size: int) -> list[np.ndarray]:
    """Sorted distinct 63-bit hashes of the word shingles of each text.

    Words are runs of other characters than ASCII white space, A-Z lower-cased.
    A text of fewer words than ``size`` is one shingle; without words, none.
    Each distinct word of the texts is hashed once; nothing is remembered.
    """
    chunks, codes, counts = distinct_chunks(pc.ascii_lower(texts), ascii_only=True)
    words = joined(chunks, "\n").encode().split(b"\n") if len(chunks) else []
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))[codes]
    real = np.fromiter(map(len, words), np.int64, len(words))[codes] > 0
    counts = np.bincount(np.repeat(np.arange(len(texts)), counts)[real], minlength=len(texts))
    hashes = hashes[real]
    windows = mix([hashes[i : max(0, len(hashes) - size + 1) + i] for i in range(size)]) if len(hashes) >= size else np.empty(0, np.int64)
    out = []
    for end, n in zip(np.cumsum(counts).tolist(), counts.tolist(), strict=True):
        if n >= size:
            out.append(np.unique(windows[end - n : end - size + 1]))
        else:
            out.append(mix([hashes[i : i + 1] for i in range(end - n, end)]) if n else np.empty(0, np.int64))
    return out


def mix(parts: list[np.ndarray]) -> np.ndarray:
    """63-bit hashes of sequences whose i-th members are in ``parts[i]``."""
    mixed = np.full(len(parts[0]), len(parts), np.uint64)
    for part in parts:
        mixed = (mixed ^ part) * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(29)
    mixed = mixed * np.uint64(0xBF58476D1CE4E5B9)
    mixed ^= mixed >> np.uint64(32)
    return (mixed >> np.uint64(1)).view(np.int64)


def needed_share(num: int, den: int, k: int = SKETCH) -> float:
    """The part of a sketch that a partner's sketch must share."""
    t = num / den
    return max(1 / k, t - SLACK * math.sqrt(t * (1 - t) / k))


def overlaps(sketches: list[np.ndarray], rows: np.ndarray, cols: np.ndarray) -> np.ndarray:
    """How many retained values each row's sketch shares with each column's, from the inverted lists of the values."""
    sizes = [len(x) for x in sketches]
    owner = np.repeat(np.arange(len(sketches)), sizes)
    _, value, counts = np.unique(np.concatenate(sketches), return_inverse=True, return_counts=True)
    shared = counts > 1
    used = shared[value]
    owner, value = owner[used], (np.cumsum(shared) - 1)[value[used]]
    order = np.argsort(value, kind="stable")
    owner, value = owner[order], value[order]
    common = np.zeros((len(rows), len(cols)), np.float32)
    width = 2048
    for start in range(0, int(shared.sum()), width):
        a, b = np.searchsorted(value, [start, start + width])
        lists = np.zeros((len(sketches), width), np.float32)
        lists[owner[a:b], value[a:b] - start] = 1
        common += lists[rows] @ lists[cols].T
    return common


def union_estimates(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For pairs of sketches (rows of ``a`` and ``b``, filled up with NO_VALUE): matches among the union's smallest values, and how many of these there are."""
    both = np.sort(np.concatenate([a, b], axis=1), axis=1)
    real = both != NO_VALUE
    again = np.zeros_like(real)
    again[:, 1:] = both[:, 1:] == both[:, :-1]
    rank = np.cumsum(real & ~again, axis=1)
    return (real & again & (rank <= a.shape[1])).sum(axis=1), np.minimum(rank[:, -1], a.shape[1])


def compare(tile: pa.Table, num: int, den: int) -> pa.Table:
    """Star edges (a, b) of the links between a tile's left and its right documents, which may be the same.

    Overlaps of sketches give candidates, the union sketch's estimate filters them
    and the full sets confirm. A pair that links found before connect is not needed.
    """
    ids = tile["doc_id"].to_numpy()
    sets = [np.frombuffer(x.as_buffer(), np.int64) for x in tile["shingles"]]
    sketches = np.full((len(sets), SKETCH), NO_VALUE)
    for i, s in enumerate(sets):
        sketches[i, : min(len(s), SKETCH)] = s[:SKETCH]
    kept = np.array([min(len(s), SKETCH) for s in sets])
    rows, cols = np.flatnonzero(tile["left"].to_numpy()), np.flatnonzero(tile["right"].to_numpy())
    common = overlaps([s[:SKETCH] for s in sets], rows, cols)
    needed = np.ceil(needed_share(num, den) * np.minimum(kept[rows][:, None], kept[cols][None]))
    common[(common < needed) | (ids[rows][:, None] == ids[cols][None])] = 0
    t = num / den

    def confirmed(i: np.ndarray, j: np.ndarray) -> np.ndarray:
        out = np.zeros(len(i), bool)
        for at in range(0, len(i), 8192):
            p, q = i[at : at + 8192], j[at : at + 8192]
            matches, k = union_estimates(sketches[p], sketches[q])
            for x in np.flatnonzero(matches >= t * k - SLACK * np.sqrt(t * (1 - t) * k)):
                a, b = sets[p[x]], sets[q[x]]
                both = len(np.intersect1d(a, b, assume_unique=True))
                out[at + x] = den * both >= num * (len(a) + len(b) - both)
        return out

    label = np.arange(len(ids))
    if common.size:
        # first each left document's best partner, which connects most groups of copies
        best = common.argmax(axis=1)
        has = common[np.arange(len(rows)), best] > 0
        i, j = rows[has], cols[best[has]]
        sure = confirmed(i, j)
        label = stars(i[sure], j[sure], len(ids))
        x, y = np.nonzero(common * (label[rows][:, None] != label[cols][None]))
        order = np.argsort(-common[x, y], kind="stable")
        i, j = rows[x[order]], cols[y[order]]
        batch = max(64, len(ids))
        while len(i):
            sure = confirmed(i[:batch], j[:batch])
            label = stars(np.concatenate([label, i[:batch][sure]]), np.concatenate([np.arange(len(ids)), j[:batch][sure]]), len(ids))
            i, j = i[batch:], j[batch:]
            apart = label[i] != label[j]
            i, j, batch = i[apart], j[apart], 2 * batch
    at = np.flatnonzero(label != np.arange(len(ids)))
    return pa.table({"a": pa.array(ids[label[at]], pa.int64()), "b": pa.array(ids[at], pa.int64())})


def links_inside(members: DataFrame, num: int, den: int) -> DataFrame:
    """Edges (a, b) that connect what links connect inside each group of ``members`` (group, doc_id, n, shingles)."""
    slim = members.groupBy("group", "doc_id").agg(F.sum("n").alias("n"))
    blocks = F.ceil(F.sum(F.col("n") + ROW) / BLOCK).cast("int").alias("blocks")
    every = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    own = F.pmod(F.xxhash64("doc_id"), F.col("blocks")).cast("int")

    def place(lo: Column, hi: Column, left: Column, right: Column) -> list[Column | str]:
        return ["group", "doc_id", lo.cast("string").alias("lo"), hi.cast("string").alias("hi"), left.alias("left"), right.alias("right")]

    def compared(places: DataFrame) -> DataFrame:
        tiles = members.select("group", "doc_id", "shingles").join(places, ["group", "doc_id"])
        # dealt anew: rows that stand by group would put all tiles of one group into one task
        return tiles.repartition("group", "lo", "hi").groupBy("group", "lo", "hi").applyInArrow(lambda t: compare(t, num, den), "a long, b long")

    open_cell = F.lit("open")
    celled, found = slim.withColumn("cell", open_cell), None
    large = keep(slim.groupBy("group").agg(blocks).where("blocks > 1"), "large-groups")
    if not large.isEmpty():
        inside = slim.join(large, "group").select("group", "doc_id", "blocks")
        # one for each of some buckets of a hash: a minimum that tasks take before the shuffle
        spread = F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(LEADERS)).alias("bucket")
        leaders = inside.groupBy("group", "blocks", spread).agg(F.min(F.struct(F.xxhash64("doc_id").alias("hash"), "doc_id")).alias("leader"))
        leaders = leaders.select("group", F.col("leader.doc_id").alias("doc_id"), every.alias("block"))
        at = F.col("block")
        led = inside.withColumn("block", own).select(*place(at, at, F.lit(True), F.lit(False)))
        found = keep(compared(led.unionByName(leaders.select(*place(at, at, F.lit(False), F.lit(True))))), "leader-links")
        cells = components(found).select(F.col("id").alias("doc_id"), F.col("component").cast("string").alias("cell"))
        celled = slim.join(cells, "doc_id", "left").withColumn("cell", F.coalesce("cell", open_cell))
    units = celled.groupBy("group", "cell").agg(blocks)
    part = lambda k: F.concat_ws(":", "cell", k)
    parts = units.select("group", "cell", every.alias("k")).select("group", "cell", part(F.col("k")).alias("part"))
    lo, hi = F.col("x.part"), F.col("y.part")
    pairs = parts.alias("x").join(parts.alias("y"), "group").where((lo <= hi) & ((F.col("x.cell") == open_cell) | (F.col("x.cell") != F.col("y.cell"))))
    pairs = pairs.select("group", lo.alias("lo"), hi.alias("hi"))
    ends = pairs.select("group", "lo", "hi", F.explode(F.array_distinct(F.array("lo", "hi"))).alias("part"))
    dealt = celled.join(units, ["group", "cell"]).select("group", "doc_id", part(own).alias("part")).join(ends, ["group", "part"])
    lo, hi = F.col("lo"), F.col("hi")
    rest = compared(dealt.select(*place(lo, hi, F.col("part") == lo, F.col("part") == hi)))
    return rest if found is None else rest.unionByName(found)


def near_duplicates(docs: DataFrame, shingle: int = 5, similarity: tuple[int, int] = (4, 5), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (doc_id, n_shingles, component_id, kept), one for each row of ``docs``.

    Two documents link if intersection / union of their shingle sets is at least
    ``similarity`` (numerator, denominator). component_id is the smallest doc_id
    reachable by links; ``kept`` is true where it is the document's own. A null
    or blank text has no shingles and links with nothing. Repeated rows link with
    each other; rows with one doc_id count as one document with the links of all;
    a row with a null doc_id is kept and has the component of its class's other
    documents, or null. Other columns are not read.
    """
    num, den = similarity
    share = needed_share(num, den)
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))

    def sketch(batches):
        for b in batches:
            for part in slices(b, 1):
                sets = shingle_sets(part.column(1), shingle)
                halves = np.frombuffer(b"".join(xxhash.xxh3_128_digest(s.tobytes()) for s in sets), "<i8").reshape(-1, 2)
                sketches = pa.array([s[:SKETCH] for s in sets], pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(map(len, sets), pa.int64()), pa.array(halves[:, 0]), pa.array(halves[:, 1]), sketches], ["doc_id", "n", "print1", "print2", "sketch"]
                )

    def shingles(batches):
        for b in batches:
            for part in slices(b, 2):
                sets = shingle_sets(part.column(2), shingle)
                raw = pa.array([s.tobytes() for s in sets], pa.binary())
                yield pa.RecordBatch.from_arrays([*part.columns[:2], pa.array(map(len, sets), pa.int64()), raw], ["group", "doc_id", "n", "shingles"])

    base = keep(source.mapInArrow(sketch, "doc_id long, n long, print1 long, print2 long, sketch array<long>"), "sketches")
    key = ["n", "print1", "print2"]
    classes = base.where("n > 0").groupBy(*key).agg(F.min("doc_id").alias("rep"))
    reps = base.where("n > 0").join(classes.where("rep is not null").select(*key, F.col("rep").alias("doc_id")), [*key, "doc_id"], "left_semi")
    postings = reps.select(F.col("doc_id").alias("rep"), F.size("sketch").alias("k"), F.explode("sketch").alias("value"))
    common = postings.groupBy("value").agg(F.count("*").alias("c")).where("c > 1")
    shared = postings.join(common, "value").groupBy("rep").agg(F.max("k").alias("k"), F.collect_set(F.struct("c", "value")).alias("values"))
    take = F.size("values") - F.ceil(F.col("k") * share).cast("int") + 1
    first = shared.where(take > 0).select("rep", F.explode(F.slice(F.sort_array("values"), F.lit(1), take)).alias("v")).select("rep", F.col("v.value").alias("value"))
    first = keep(first, "lists")
    hubs = first.groupBy("value").agg(F.min("rep").alias("hub"), F.max("rep").alias("last")).where("hub < last")
    groups = components(first.join(hubs, "value").select(F.col("hub").alias("a"), F.col("rep").alias("b")).distinct())
    groups = groups.select(F.col("id").alias("doc_id"), F.col("component").alias("group"))

    # a Bloom filter of bounded size keeps the texts of other documents out of the shuffle
    groups = keep(groups, "groups")
    wanted = groups.select(F.col("doc_id").cast("string").alias("entry"))
    near = url_filter.may_hold(source, F.col("doc_id").cast("string"), *url_filter.build_filter(wanted, groups.count()))
    members = near.join(groups, "doc_id").select("group", "doc_id", "text").mapInArrow(shingles, "group long, doc_id long, n long, shingles binary")
    members = keep(members.where("n > 0"), "members")
    edges = links_inside(members, num, den)
    linked = components(edges).select(F.col("id").alias("rep"), "component")
    for done in (first, groups, members):  # the components stand in a table of their own
        drop_kept(done)

    answer = classes.select(*key, "rep").join(linked, "rep", "left").select(*key, F.coalesce("component", "rep").alias("component_id"))
    out = base.select("doc_id", *key).join(answer, key, "left")
    component = F.coalesce("component_id", "doc_id")
    return out.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))
