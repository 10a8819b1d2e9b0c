"""Column functions over pages, paths and blocks of notes."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

#: How a block of each kind stands in Markdown, without kinds that lines are quoted or fenced for.
PREFIXES = {"heading_1": "# ", "heading_2": "## ", "heading_3": "### ", "bulleted": "- ", "numbered": "1. ", "to_do": "- [ ] "}
#: A run of backticks up to the next one as wide. An odd number of backslashes before it or a blank line inside makes it ordinary text.
CODE_SPAN = r"(?<!\\)(?:\\\\)*+(?<!`)((`++)(?:[^`\n]++|\n(?![ \t]*\n)|(?!\2(?!`))`++)*+\2(?!`))"


def meta_content(html: Column, key: str, name: str) -> Column:
    """The content of the first meta tag whose attribute ``key`` is ``name``, in any order of attributes; empty without one."""
    tags = F.regexp_extract_all(html, F.lit(r"(?i)<meta\b[^>]*>"), F.lit(0))
    wanted = F.filter(tags, lambda t: t.rlike(rf"(?i)(?<![\w-]){key}\s*=\s*[\"']{re.escape(name)}[\"']"))
    return F.coalesce(F.regexp_extract(F.get(wanted, F.lit(0)), r"(?is)(?<![\w-])content\s*=\s*([\"'])(.*?)\1", 2), F.lit(""))


def glob_pattern(glob: str) -> str:
    """A regular expression for a path glob: ``**`` crosses folders, ``*`` and ``?`` do not."""
    say = {"**/": "(?:.*/)?", "**": ".*", "*": "[^/]*", "?": "[^/]"}
    return "^" + "".join(say.get(part, re.escape(part)) for part in re.split(r"(\*\*/|\*\*|\*|\?)", glob)) + "$"


def tracked(path: Column, include: tuple[str, ...], exclude: tuple[str, ...] = ()) -> Column:
    """Whether a path fits a glob of ``include`` and none of ``exclude``; null for a null path."""
    fits = lambda globs: reduce(lambda a, b: a | b, (path.rlike(glob_pattern(g)) for g in globs), F.lit(False))
    return fits(include) & ~fits(exclude)


def code_spans(text: Column) -> Column:
    """The inline code spans of a text with their backticks, in order."""
    return F.regexp_extract_all(text, F.lit(CODE_SPAN), F.lit(1))


def markdown_of(blocks: Column) -> Column:
    """Blocks (kind, text) as Markdown, a blank line between; kinds that are not known stand as paragraphs."""

    def one(block: Column) -> Column:
        kind, text = block["kind"], F.coalesce(block["text"], F.lit(""))
        out = F.when(kind == "quote", F.concat(F.lit("> "), F.replace(text, F.lit("\n"), F.lit("\n> "))))
        out = out.when(kind == "code", F.concat(F.lit("```\n"), text, F.lit("\n```"))).when(kind == "divider", F.lit("---"))
        for name, prefix in PREFIXES.items():
            out = out.when(kind == name, F.concat(F.lit(prefix), text))
        return out.otherwise(text)

    return F.array_join(F.transform(blocks, one), "\n\n")


def projected(fields: list[tuple[str, Column, tuple[str, ...]]], budget: int) -> Column:
    """Fields (name, value, allowed values or none) as a struct (reasons, bytes).

    A field is written, missing (null), not among its allowed values, or over the
    budget: more bytes than those written before it leave. A field that is not
    written costs nothing.
    """

    def rows() -> Column:
        out = []
        for name, value, allowed in fields:
            refused = F.when(value.isNull(), "missing")
            if allowed:
                refused = refused.when(~value.isin(*allowed), "option_unavailable")
            out.append(F.struct(F.lit(name).alias("name"), refused.alias("refused"), F.octet_length(F.coalesce(value, F.lit(""))).cast("long").alias("size")))
        return F.array(*out)

    def step(state: Column, x: Column) -> Column:
        reason = F.coalesce(x["refused"], F.when(state["bytes"] + x["size"] > budget, "budget"), F.lit("written"))
        used = F.when(x["refused"].isNull() & (state["bytes"] + x["size"] <= budget), x["size"]).otherwise(F.lit(0).cast("long"))
        return F.struct(F.concat(state["reasons"], F.array(F.concat(x["name"], F.lit("="), reason))).alias("reasons"), (state["bytes"] + used).alias("bytes"))

    start = F.struct(F.array().cast("array<string>").alias("reasons"), F.lit(0).cast("long").alias("bytes"))
    return F.aggregate(rows(), start, step)


def paired(blocks: Column, limit: int, most_runs: int = 100) -> Column:
    """Blocks (text, joins, color, runs) with neighbours joined in pairs until at most ``limit`` are left, as a struct (blocks, merged).

    Pairs are taken from the left and do not overlap; both must be of a kind that
    joins and of one color and together have at most ``most_runs`` runs, one for
    the blank line between. If that is not enough, or there are at most ``limit``
    or over twice as many blocks, all stay as they are.
    """
    needed = F.size(blocks) - limit

    def put(x: Column, single: Column) -> Column:
        return F.struct(x["text"].alias("text"), x["joins"].alias("joins"), x["color"].alias("color"), x["runs"].cast("int").alias("runs"), single.alias("single"))

    def step(state: Column, x: Column) -> Column:
        out = state["blocks"]
        last = F.element_at(out, -1)
        runs = last["runs"] + x["runs"].cast("int") + 1
        fits = (F.size(out) > 0) & (state["merged"] < needed) & last["single"] & last["joins"] & x["joins"] & last["color"].eqNullSafe(x["color"]) & (runs <= most_runs)
        joined = F.struct(F.concat(last["text"], F.lit("\n\n"), x["text"]).alias("text"), last["joins"].alias("joins"), last["color"].alias("color"), runs.alias("runs"), F.lit(False).alias("single"))
        more = F.when(F.coalesce(fits, F.lit(False)), F.concat(F.slice(out, 1, F.greatest(F.size(out) - 1, F.lit(0))), F.array(joined))).otherwise(F.concat(out, F.array(put(x, F.lit(True)))))
        return F.struct(more.alias("blocks"), (state["merged"] + F.coalesce(fits, F.lit(False)).cast("int")).alias("merged"))

    none = F.array().cast("array<struct<text:string,joins:boolean,color:string,runs:int,single:boolean>>")
    # outside the range the fold has nothing to walk
    walked = F.when(F.size(blocks).between(limit + 1, 2 * limit), blocks).otherwise(F.slice(blocks, 1, 0))
    folded = F.aggregate(walked, F.struct(none.alias("blocks"), F.lit(0).alias("merged")), step)
    done = lambda f: (f["merged"] > 0) & (F.size(f["blocks"]) <= limit)
    as_it_is = F.transform(blocks, lambda x: x["text"])
    result = lambda f: F.struct(F.when(done(f), F.transform(f["blocks"], lambda x: x["text"])).otherwise(as_it_is).alias("blocks"), F.when(done(f), f["merged"]).otherwise(F.lit(0)).alias("merged"))
    # a lambda's argument is taken once, however often the result names it
    return F.get(F.transform(F.array(folded), result), F.lit(0))
