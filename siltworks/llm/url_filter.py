"""URL filter: a blocked Bloom filter over listed canonical URLs, then an exact hash join.

A listed entry is ``host + path`` in canonical form. It fits a URL if its host is
the URL's host or a parent domain of it and its path is a prefix of the URL's
path, ending at a slash or at the path's end. So each URL is looked up under
every combination of host suffix and path prefix that the list can hold. The
filter has blocks of four 64-bit words; one hash names the block, another one bit
in each word, so a look-up reads one block. A page whose look-ups all fail gets
its verdict in the same pass, without a shuffle; what passes goes to an exact join
that removes false positives. DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Blocks of a filter that is broadcast at most (256 bits each, 32 MB); a larger one is shuffled by block.
MAX_BLOCKS = 1 << 20
#: Bits of the filter for each listed entry; 64-bit words of a block, in each of which an entry sets one bit.
BITS_PER_ENTRY, BLOCK_WORDS = 16, 4
#: A list of at most so many entries is broadcast to the exact join; a longer one is shuffled.
SMALL_LIST = 100_000


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in lower case; else empty."""
    rest = F.when(F.instr(url, "://") > 0, F.substring_index(F.regexp_replace(url, r"(?s)^.*?://", ""), "/", 1)).otherwise("")
    host = F.substring_index(F.substring_index(rest, "?", 1), "#", 1)
    return F.coalesce(F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; else empty."""
    rest = F.when(F.instr(url, "://") > 0, F.regexp_replace(url, r"(?s)^.*?://", "")).otherwise("")
    bare = F.substring_index(F.substring_index(rest, "?", 1), "#", 1)
    slash = F.instr(bare, "/")
    return F.coalesce(F.when(slash > 0, F.substr(bare, slash)).otherwise(""), F.lit(""))


def block_of(key: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(blocks))


def mask_of(key: Column, word: int) -> Column:
    """The bit of ``key`` in 64-bit word ``word`` of its block."""
    bit = F.shiftrightunsigned(F.xxhash64(key, F.lit(7)), 6 * word).bitwiseAND(F.lit(63)).cast("int")
    return F.call_function("shiftleft", F.lit(1).cast("long"), bit)


def build_filter(listed: DataFrame, entries: int) -> tuple[DataFrame, int]:
    """The filter's table of blocks (block, w0..w3) and their number, for rows (entry)."""
    blocks = max(1, -(-entries * BITS_PER_ENTRY // (64 * BLOCK_WORDS)))
    words = range(BLOCK_WORDS)
    bits = listed.select(block_of(F.col("entry"), blocks).alias("block"), *(mask_of(F.col("entry"), w).alias(f"w{w}") for w in words))
    return bits.groupBy("block").agg(*(F.bit_or(f"w{w}").alias(f"w{w}") for w in words)), blocks


def may_hold(df: DataFrame, key: Column, blooms: DataFrame, blocks: int) -> DataFrame:
    """The rows of ``df`` whose key passes the filter: all that are listed, and a few others."""
    names = df.columns
    table = F.broadcast(blooms) if blocks <= MAX_BLOCKS else blooms
    passed = df.withColumns({"__key": key, "block": block_of(key, blocks)}).join(table, "block")
    for w in range(BLOCK_WORDS):
        mask = mask_of(F.col("__key"), w)
        passed = passed.where(F.col(f"w{w}").bitwiseAND(mask) == mask)
    return passed.select(*names)


def one_row(blooms: DataFrame, blocks: int) -> DataFrame:
    """The words of a filter of at most MAX_BLOCKS blocks in one row (bits)."""
    every = blooms.sparkSession.range(blocks).withColumnRenamed("id", "block").join(blooms, "block", "left")
    words = F.array(*(F.coalesce(f"w{w}", F.lit(0).cast("long")) for w in range(BLOCK_WORDS)))
    return every.agg(F.sort_array(F.collect_list(F.struct("block", words.alias("words")))).alias("all")).select(F.flatten("all.words").alias("bits"))


def passing(keys: Column, bits: Column, blocks: int) -> Column:
    """The keys of an array that pass the filter in ``bits``."""

    def passes(key: Column) -> Column:
        at = (block_of(key, blocks) * BLOCK_WORDS).cast("int")
        out = F.lit(True)
        for w in range(BLOCK_WORDS):
            mask = mask_of(key, w)
            out = out & (F.get(bits, at + w).bitwiseAND(mask) == mask)
        return out

    return F.filter(keys, passes)


def judge(pages: DataFrame, listed: DataFrame, default: str = "allow", id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """Rows (page_id, host, path, rule, verdict, listed), one for each page.

    ``listed`` has columns entry (canonical ``host/path``), verdict and given: true
    for a rule, false for an entry of the URL list. Rules win over list entries,
    then the longest entry that fits wins, of equal entries the smallest verdict.
    ``rule`` and ``listed`` name the entry that decided; without one, both are null
    and verdict is ``default``. A null url, or one without ``://``,
    has an empty host and path and fits nothing. Repeated rows and null ids give
    a row each; other columns are not read.
    """
    rules = listed.where("entry is not null and instr(entry, '/') > 0").groupBy("entry").agg(F.min(F.struct(F.col("given").cast("int") * -1, "verdict", "given")).alias("e"))
    rules = rules.select("entry", "e.verdict", "e.given")
    shape = rules.agg(
        F.count("*").alias("n"),
        F.max(F.size(F.split(F.substring_index("entry", "/", 1), r"\."))).alias("labels"),
        F.max(F.length("entry") - F.length(F.replace("entry", F.lit("/")))).alias("slashes"),
    ).first()
    source = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"))
    parsed = source.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    if not shape["n"]:
        return parsed.select("page_id", "host", "path", F.lit(None).cast("string").alias("rule"), F.lit(default).alias("verdict"), F.lit(None).cast("string").alias("listed"))
    # no entry has more labels or slashes than these, so longer suffixes and prefixes cannot be listed
    labels, slashes = F.split("host", r"\."), F.split("path", "/")
    suffixes = F.transform(F.sequence(F.lit(1), F.least(F.size(labels), F.lit(shape["labels"]))), lambda k: F.call_function("substring_index", F.col("host"), F.lit("."), -k))
    prefixes = F.array_union(
        F.transform(F.sequence(F.lit(1), F.least(F.size(slashes) - 1, F.lit(shape["slashes"]))), lambda k: F.concat(F.call_function("substring_index", F.col("path"), F.lit("/"), k), F.lit("/"))),
        F.array("path"),
    )
    looked_up = F.when(
        (F.col("host") != "") & F.startswith("path", F.lit("/")),
        F.flatten(F.transform(suffixes, lambda s: F.transform(prefixes, lambda p: F.concat(s, p)))),
    )
    blooms, blocks = build_filter(rules, shape["n"])
    looked = parsed.withColumn("entries", looked_up)
    if blocks <= MAX_BLOCKS:
        looked = looked.crossJoin(F.broadcast(one_row(blooms, blocks))).withColumn("entries", passing(F.col("entries"), F.col("bits"), blocks)).drop("bits")
    some = F.coalesce(F.size("entries") > 0, F.lit(False))
    hits = looked.where(some)
    # one row for each different host and path: one that a third of the pages share is joined once
    keys = hits.select("host", "path", "entries").distinct().select("host", "path", F.explode("entries").alias("entry"))
    if blocks > MAX_BLOCKS:
        keys = may_hold(keys, F.col("entry"), blooms, blocks)
    exact = F.broadcast(rules) if shape["n"] <= SMALL_LIST else rules
    fits = keys.join(exact, "entry").groupBy("host", "path").agg(F.max(F.struct("given", F.length("entry").alias("n"), "entry", "verdict")).alias("best"))

    def judged(found: DataFrame, best: Column) -> DataFrame:
        return found.select(
            "page_id", "host", "path",
            F.when(best["given"], best["entry"]).alias("rule"),
            F.coalesce(best["verdict"], F.lit(default)).alias("verdict"),
            F.when(~best["given"], best["entry"]).alias("listed"),
        )

    nothing = F.lit(None).cast(fits.schema["best"].dataType)
    # AQE splits a hot host and path on the side of the pages
    return judged(looked.where(~some), nothing).unionByName(judged(hits.join(fits, ["host", "path"], "left"), F.col("best")))
