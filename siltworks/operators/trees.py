"""Trees and chains given by parent pointers, of any size and depth.

Pointers are jumped: in each round a node takes over the pointer of the node it
points at, so a depth of d needs log2(d) rounds, each one join and one table in
the shared folder. Nodes that no number of rounds brings to an end are on or
below a cycle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from siltworks.operators.joining import look_up
from siltworks.sources.state import forget, kept


def walk(nodes: DataFrame, key: str, parent: str, any_of: Sequence[str] = (), limit: int = 30, trail: bool = False, steps: str | None = None) -> DataFrame:
    """Rows (key, parent, root, depth, outcome, columns of ``any_of``, and the trail if asked for).

    ``outcome`` is ``ok``, ``repeated`` (the key comes twice; its smallest parent
    counts), ``cycle``, ``orphan`` (a parent on the way is missing; ``root`` is the
    node below it) or ``too_deep`` (more than ``limit`` steps from the root). A
    column of ``any_of`` is true where it is for the node or a node on its way up.
    On and below cycles root, depth and trail are null. ``trail`` has the keys from
    the root, of nodes up to ``limit`` deep. Rows without a key are left out. A
    column ``steps`` says how many steps a node is below its parent, 1 if not given.
    """
    one = nodes.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("id")).agg(
        F.min(parent).alias("parent"), (F.count("*") > 1).alias("twice"), (F.min(steps) if steps else F.lit(1)).cast("long").alias("steps"), *(F.coalesce(F.max(F.col(c)), F.lit(False)).alias(f"f{i}") for i, c in enumerate(any_of)),
    )
    flags = [f"f{i}" for i in range(len(any_of))]
    one = kept(one, "tree-nodes")
    total = one.count()
    known = look_up(one, "parent", one.select(F.col("id").alias("above"), F.lit(True).alias("here")), "above")
    end = F.when(F.col("parent").isNull(), "ok").when(F.col("here").isNull(), "orphan")
    start = known.select(
        "id", "parent", "twice", *flags, end.alias("end"), F.when(F.col("here"), F.col("parent")).alias("up"), F.when(F.col("here"), F.col("steps")).otherwise(0).alias("hops"),
        F.when(F.col("here").isNull(), F.col("id")).alias("root"), *([F.col("id").cast("string").alias("trail")] if trail else []),
    )
    state, reach = kept(start, "tree"), 1
    while reach < 2 * total and not (waiting := state.where("end is null")).isEmpty():
        facts = state.select(F.col("id").alias("at"), *(F.col(c).alias(f"to_{c}") for c in ("end", "up", "hops", "root", *flags, *(["trail"] if trail else []))))
        found = look_up(waiting, "up", facts, "at")
        hops = F.col("hops") + F.col("to_hops")
        # a trail longer than the limit is not needed, and on a cycle it would double for ever
        joined = F.when(hops <= limit, F.concat("to_trail", F.lit("/"), "trail")) if trail else None
        moved = found.select(
            "id", "parent", "twice", *((F.col(f) | F.col(f"to_{f}")).alias(f) for f in flags), F.col("to_end").alias("end"), F.col("to_up").alias("up"), hops.alias("hops"), F.col("to_root").alias("root"),
            *([joined.alias("trail")] if trail else []),
        )
        after = kept(state.where("end is not null").unionByName(moved), "tree")
        forget(state)
        state, reach = after, 2 * reach
    open_ended = F.col("end").isNull()
    outcome = F.when(F.col("twice"), "repeated").when(open_ended, "cycle").when(F.col("end") == "orphan", "orphan").when(F.col("hops") > limit, "too_deep").otherwise("ok")
    return state.select(
        F.col("id").alias(key), F.col("parent").alias(parent), "root", F.when(~open_ended, F.col("hops")).alias("depth"), outcome.alias("outcome"), *(F.col(f).alias(c) for f, c in zip(flags, any_of, strict=True)),
        *([F.when(~open_ended & (F.col("hops") <= limit), F.col("trail")).alias("trail")] if trail else []),
    )


#: So many numbers of a chain are searched for runs in one task at most.
BLOCK = 1 << 16


def admitted_chain(receipts: DataFrame, key: str, previous: str, sequence: str, chain: str) -> DataFrame:
    """Receipts that name the one before them: rows (key, chain, sequence, depth, outcome).

    ``outcome`` is, in this order: ``repeated``; ``cycle``; ``gap`` where a receipt on
    the way back is missing; ``fork`` where on the way back two receipts name one
    before them, or two of a chain have one sequence number; ``misnumbered`` where
    a number is not one more than the one before; else ``admitted``.

    Most receipts name their neighbour by number. Such runs are found by windows over
    blocks of a chain's numbers, and only their heads are looked up and walked; the
    others stand a known number of steps below their head. So receipts are shuffled
    a fixed number of times, however long the chains; where no receipt names its
    neighbour, each is a run and all are walked.
    """
    own = receipts.where(F.col(key).isNotNull()).select(F.col(key).alias("id"), F.col(previous).alias("before"), F.col(sequence).alias("number"), F.col(chain).alias("chain"))
    repeated = kept(own.groupBy("id").agg(F.count("*").alias("n")).where("n > 1").select("id", F.lit(True).alias("twice")), "receipts-repeated")
    marked = own.withColumn("twice", F.lit(False)) if repeated.isEmpty() else own.join(repeated, "id", "left").withColumn("twice", F.coalesce("twice", F.lit(False)))
    # rows without a chain or number have no neighbours; a hash deals them out
    placed = F.col("chain").isNotNull() & F.col("number").isNotNull()
    blocks = marked.withColumn("block", F.when(placed, F.floor(F.col("number") / BLOCK)).otherwise(F.xxhash64("id")).cast("long"))
    block = Window.partitionBy("chain", "block").orderBy("number", "id")
    same = Window.partitionBy("chain", "block", "number")
    near = lambda c: F.lag(c).over(block)
    follows = F.coalesce(placed & (F.col("before") == near("id")) & ~F.col("twice") & ~near("twice"), F.lit(False))
    seen = blocks.withColumn("follows", follows).withColumn("two", placed & (F.min("id").over(same) != F.max("id").over(same)))
    seen = seen.withColumn("odd", F.col("follows") & (F.col("number") != near("number") + 1)).withColumn("run", F.sum((~F.col("follows")).cast("long")).over(block.rowsBetween(Window.unboundedPreceding, 0)))
    run = Window.partitionBy("chain", "block", "run").orderBy("number", "id")
    to_here = run.rowsBetween(Window.unboundedPreceding, 0)
    nodes = kept(
        seen.select(
            "id", F.when(~F.col("follows"), F.col("before")).alias("before"), "number", "chain", "twice", F.first("id").over(to_here).alias("head"), (F.row_number().over(run) - 1).cast("long").alias("at"),
            F.max("two").over(to_here).alias("two"), F.max("odd").over(to_here).alias("odd"), F.coalesce(F.lead("follows").over(run), F.lit(False)).alias("followed"),
        ),
        "receipts",
    )
    # what a head's pointer meets: the run it enters, and how far down
    heads = nodes.where("at = 0").select("id", "before", "number", "two")
    named = heads.where("before is not null").groupBy("before").agg(F.count_distinct("id").alias("n"))
    met = nodes.join(named.select(F.col("before").alias("id")), "id", "left_semi").groupBy("id").agg(
        F.min("head").alias("to"), F.min("at").alias("down"), F.max("two").alias("to_two"), F.max("odd").alias("to_odd"), F.min("number").alias("last"), F.max("followed").alias("followed")
    )
    facts = kept(named.join(met.withColumnRenamed("id", "before"), "before", "left").withColumn("fork", F.col("n") + F.coalesce("followed", F.lit(False)).cast("int") > 1), "receipts-named")
    # the first receipt of a run that is forked because a head of another run names the one before it, too
    cuts = facts.where("fork and followed").groupBy("to").agg((F.min("down") + 1).alias("cut"))
    entered = look_up(heads, "before", facts.select(F.col("before").alias("of"), "to", "down", "to_two", "to_odd", "last", "fork"), "of")
    entered = look_up(entered, "to", cuts.withColumnRenamed("to", "of"), "of")
    off = lambda c: F.coalesce(c, F.lit(False))
    edges = entered.select(
        "id", F.coalesce("to", "before").alias("parent"), (F.col("down") + 1).alias("steps"), (off(F.col("fork")) | F.col("two") | off(F.col("to_two")) | off(F.col("down") >= F.col("cut"))).alias("forked"),
        (off(F.col("number") != F.col("last") + 1) | off(F.col("to_odd"))).alias("misnumbered"), "before",
    )
    # of a repeated receipt the smallest name counts, as walk takes it; the marks of all its rows
    edges = edges.groupBy("id").agg(F.min_by("parent", "before").alias("parent"), F.min_by("steps", "before").alias("steps"), F.max("forked").alias("forked"), F.max("misnumbered").alias("misnumbered"))
    walked = walk(edges, "id", "parent", any_of=["forked", "misnumbered"], limit=1 << 62, steps="steps")
    ends = walked.join(cuts.withColumnRenamed("to", "id"), "id", "left").select(F.col("id").alias("of"), F.col("depth").alias("head_depth"), "outcome", "forked", "misnumbered", "cut")
    one = nodes if repeated.isEmpty() else nodes.where("not twice").drop("before").unionByName(
        nodes.where("twice").groupBy("id").agg(F.min("number").alias("number"), F.min("chain").alias("chain"), F.lit(True).alias("twice"), F.first("head").alias("head"), F.min("at").alias("at"), F.max("two").alias("two"), F.max("odd").alias("odd"), F.max("followed").alias("followed"))
    )
    found = one.select("id", "chain", "number", "twice", "head", "at", "two", "odd").join(ends, F.col("head") == F.col("of"))
    outcome = (
        F.when(F.col("twice"), "repeated").when(F.col("outcome") == "cycle", "cycle").when(F.col("outcome") == "orphan", "gap").when(F.col("forked") | F.col("two") | off(F.col("at") >= F.col("cut")), "fork")
        .when(F.col("misnumbered") | F.col("odd"), "misnumbered").otherwise("admitted")
    )
    return found.select(F.col("id").alias(key), "chain", F.col("number").alias("sequence"), (F.col("head_depth") + F.col("at")).alias("depth"), outcome.alias("outcome"))


def path_history(creations: DataFrame, renames: DataFrame, path: str = "path", source: str = "source", at: str = "at") -> DataFrame:
    """When a path named which file: rows (path, start, end, file), end open where it is null.

    A path names a file from its creation there or its rename to it, until it is
    renamed away or another one comes to the path. ``file`` is where the file was
    created, as ``path@start``, found by following its renames back; null where a
    rename started from a path that named no file. A path may be used again.
    """
    opens = creations.select(F.col(path).alias("path"), F.col(at).alias("start"), F.lit(None).cast("string").alias("before")).unionByName(
        renames.select(F.col(path).alias("path"), F.col(at).alias("start"), F.col(source).alias("before"))
    )
    moves = opens.select("path", F.col("start").alias("t"), F.lit(True).alias("comes"), "before").unionByName(
        renames.select(F.col(source).alias("path"), F.col(at).alias("t"), F.lit(False).alias("comes"), F.lit(None).cast("string").alias("before"))
    )
    after = F.lead("t").over(Window.partitionBy("path").orderBy("t", F.col("comes")))
    spans = moves.withColumn("end", after).where("comes").select("path", F.col("t").alias("start"), "end", "before", F.concat("path", F.lit("@"), F.col("t").cast("string")).alias("id"))
    spans = kept(spans, "path-spans")
    ended = spans.select(F.col("path").alias("before"), F.col("end").alias("start"), F.col("id").alias("parent"))
    linked = spans.join(ended, ["before", "start"], "left")
    lost = F.col("before").isNotNull() & F.col("parent").isNull()
    found = walk(linked.withColumn("lost", lost), "id", "parent", any_of=["lost"], limit=1 << 62)
    return spans.join(found.select("id", F.when(~F.col("lost") & (F.col("outcome") == "ok"), F.col("root")).alias("file")), "id").select("path", "start", "end", "file")


def bound_attachments(blocks: DataFrame, history: DataFrame, receipts: DataFrame, key: str) -> DataFrame:
    """Which receipt each attachment block (key, path, at, upload_id, sha256, size) stands for: rows (key, file, receipt, outcome).

    The block's path is read as of its time. Of its file's receipts (receipt, file,
    upload_id, sha256, size, verified) those with the block's upload id count, or
    where it has none, those with its hash and size: exactly one, and verified, is
    ``bound``; else ``no_file``, ``missing``, ``ambiguous`` or ``unverified``.
    """
    then = (F.col("path") == F.col("h_path")) & (F.col("h_start") <= F.col("at")) & (F.col("h_end").isNull() | (F.col("at") < F.col("h_end")))
    spans = history.select(F.col("path").alias("h_path"), F.col("start").alias("h_start"), F.col("end").alias("h_end"), "file")
    placed = blocks.join(spans, then, "left").select(key, "file", "upload_id", "sha256", "size")
    known = receipts.select("receipt", "file", F.col("upload_id").alias("r_upload"), F.col("sha256").alias("r_sha"), F.col("size").alias("r_size"), "verified")
    fits = F.when(F.col("upload_id").isNotNull(), F.col("upload_id") == F.col("r_upload")).otherwise((F.col("sha256") == F.col("r_sha")) & (F.col("size") == F.col("r_size")))
    hits = placed.join(known, "file").where(fits).groupBy(key).agg(F.count("*").alias("n"), F.min("receipt").alias("receipt"), F.every("verified").alias("verified"))
    outcome = (
        F.when(F.col("file").isNull(), "no_file").when(F.col("n").isNull(), "missing").when(F.col("n") > 1, "ambiguous").when(~F.coalesce("verified", F.lit(False)), "unverified").otherwise("bound")
    )
    return placed.join(hits, key, "left").withColumn("outcome", outcome).select(key, "file", F.when(F.col("outcome") == "bound", F.col("receipt")).alias("receipt"), "outcome")
