"""Markdown texts as typed blocks, with array functions only: lines are sliced at fences, at tables, and where blocks begin."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

BLOCK = "struct<type:string,level:int,lang:string,text:string>"
#: Rows of a table on one page; the header is repeated.
TABLE_ROWS = 80
DIVIDER = r"\A\s*\|*\s*:?-{3,}:?\s*(?:\|\s*:?-{3,}:?\s*)+\|*\s*\z"


def strip(text: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(text, r"\A\s+", ""), r"\s+\z", "")


def block(kind: str | Column, text: Column, level: Column | int = 0, lang: Column | str = "") -> Column:
    as_column = lambda v: v if isinstance(v, Column) else F.lit(v)
    return F.struct(as_column(kind).alias("type"), as_column(level).cast("int").alias("level"), as_column(lang).alias("lang"), text.alias("text"))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is worked out once, however often it is used."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def upto(n: Column) -> Column:
    """0, 1, ... n - 1."""
    return F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))


def span(items: Column, start: Column, end: Column) -> Column:
    return F.slice(items, start + 1, F.greatest(end - start, F.lit(0)))


def line_kind(line: Column, nested: bool) -> Column:
    indent = r"[ \t]*" if nested else ""
    return (
        F.when(line.rlike(r"\A\s*\z"), "blank").when(line.rlike(r"\A#{1,6}\s+"), "heading").when(line.rlike(r"\A\s*(?:---|___|\*\*\*)\s*\z"), "divider")
        .when(line.rlike(rf"\A{indent}[-*]\s+"), "bullet").when(line.rlike(rf"\A{indent}\d+\.\s+"), "number").when(F.startswith(line, F.lit(">")), "quote").otherwise("paragraph")
    )


def text_blocks(lines: Column, nested: bool) -> Column:
    """Blocks of lines without fences and tables."""
    alone = lambda k: k.isin("heading", "divider", "bullet", "number")

    def one(kinds: Column, start: Column, end: Column) -> Column:
        first, kind, part = F.get(lines, start), F.get(kinds, start), span(lines, start, end)
        quoted = F.array_join(F.transform(part, lambda x: F.regexp_replace(x, r"\A>\s?", "")), "\n")
        whole = F.when(kind == "quote", quoted).otherwise(F.array_join(F.transform(part, lambda x: F.regexp_replace(x, r"\s+\z", "")), "\n"))
        mark = F.when(kind == "heading", r"\A#{1,6}\s+").when(kind == "bullet", r"\A[ \t]*[-*]\s+").otherwise(r"\A[ \t]*\d+\.\s+")
        text = F.when(kind == "divider", "").when(alone(kind), strip(F.regexp_replace(first, mark, F.lit("")))).otherwise(strip(whole))
        depth = F.floor(F.length(F.regexp_replace(F.regexp_extract(first, r"\A([ \t]*)", 1), "\t", "  ")) / 2) if nested else F.lit(0)
        level = F.when(kind == "heading", F.least(F.length(F.regexp_extract(first, r"\A(#+)", 1)), F.lit(3))).when(kind.isin("bullet", "number"), depth).otherwise(0)
        return block(kind, text, level)

    def of_kinds(kinds: Column) -> Column:
        begins = F.filter(upto(F.size(lines)), lambda i: (i == 0) | alone(F.get(kinds, i)) | (F.get(kinds, i) != F.get(kinds, i - 1)))
        return let(begins, lambda starts: F.transform(starts, lambda s, at: one(kinds, s, F.coalesce(F.get(starts, at + 1), F.size(lines)))))

    return F.filter(let(F.transform(lines, lambda x: line_kind(x, nested)), of_kinds), lambda b: b["type"] != "blank")


def cells(line: Column) -> Column:
    bare = F.regexp_replace(F.regexp_replace(strip(line), r"\A\|+", ""), r"\|+\z", "")
    return F.transform(F.split(bare, r"(?<!\\)\|"), lambda c: F.replace(strip(c), F.lit("\\|"), F.lit("|")))


def table_blocks(lines: Column) -> Column:
    """The pages of a table: JSON lists of its rows, all of one width, each page with the header."""

    def paged(even: Column) -> Column:
        offsets = F.sequence(F.lit(0), F.greatest(F.size(even) - 2, F.lit(0)), F.lit(TABLE_ROWS))
        return F.transform(offsets, lambda o: block("table", F.to_json(F.concat(F.slice(even, 1, 1), F.slice(even, o + 2, F.lit(TABLE_ROWS)))), F.size(F.get(even, F.lit(0)))))

    def filled(rows: Column) -> Column:
        return let(F.array_max(F.transform(rows, lambda r: F.size(r))), lambda width: let(F.transform(rows, lambda r: F.concat(r, F.array_repeat(F.lit(""), width - F.size(r)))), paged))

    return let(F.transform(F.concat(F.slice(lines, 1, 1), F.slice(lines, F.lit(3), F.size(lines))), cells), filled)


def pieces(lines: Column, cuts: Column, text: Callable[[Column], Column], cut: Callable[[Column], Column]) -> Column:
    """Blocks of the lines between and in some stretches (from, to), in order."""
    place = lambda v: F.struct(v.alias("from"), v.alias("to"))
    empty = F.array().cast(f"array<{BLOCK}>")

    def each(ends: Column) -> Column:
        return F.transform(
            F.slice(ends, F.lit(2), F.size(ends)), lambda c, i: F.concat(let(span(lines, F.get(ends, i)["to"], c["from"]), text), F.when(c["to"] > c["from"], let(span(lines, c["from"], c["to"]), cut)).otherwise(empty))
        )

    return F.flatten(let(F.concat(F.array(place(F.lit(0))), cuts, F.array(place(F.size(lines)))), each))


def with_tables(lines: Column, nested: bool) -> Column:
    """Blocks of lines without fences. A line with bars over a divider starts a table, which lasts as long as lines have bars."""

    def of_bars(barred: Column) -> Column:
        at = lambda i: F.coalesce(F.get(barred, i), F.lit(False))
        first = F.filter(upto(F.size(lines)), lambda i: at(i) & ~F.when(i > 0, at(i - 1)).otherwise(False))
        last = F.filter(upto(F.size(lines)), lambda i: at(i) & ~at(i + 1))
        under = lambda i: F.get(lines, i + 1).rlike(DIVIDER)
        runs = F.transform(F.arrays_zip(first.alias("a"), last.alias("b")), lambda r: F.struct(F.get(F.filter(F.sequence(r["a"], r["b"]), lambda i: (i < r["b"]) & under(i)), F.lit(0)).alias("from"), (r["b"] + 1).alias("to")))
        return let(F.filter(runs, lambda h: h["from"].isNotNull()), lambda heads: pieces(lines, heads, lambda part: text_blocks(part, nested), table_blocks))

    return let(F.transform(lines, lambda x: x.contains("|") & ~x.rlike(r"\A\s*\z")), of_bars)


def markdown_blocks(text: Column, dialect: str = "tables") -> Column:
    """The blocks of a Markdown text as structs (type, level, lang, text); null and empty texts have none.

    Types: heading (levels over 3 count as 3), paragraph, quote, bullet, number,
    divider, code (with its language) and table (level is its width, text a JSON list
    of rows; at most 80 rows and the header a block). A front matter head becomes a
    heading and a code block. Dialects: ``plain`` has no tables and no nesting,
    ``tables`` has tables, ``nested`` has tables and list items as deep as their
    indent says (level). A fence is a line that starts with three backticks; one that
    is not closed lasts to the end.
    """
    between = (lambda part: text_blocks(part, False)) if dialect == "plain" else (lambda part: with_tables(part, dialect == "nested"))

    def fenced(part: Column) -> Column:
        first, is_fence = F.get(part, F.lit(0)), lambda x: F.startswith(x, F.lit("```"))
        lang = strip(F.substr(first, F.lit(4), F.length(first)))
        closed = F.when((F.size(part) > 1) & is_fence(F.element_at(part, -1)), F.size(part) - 2).otherwise(F.size(part) - 1)
        return F.array(block("code", F.array_join(F.slice(part, F.lit(2), closed), "\n"), 0, F.when(lang == "", "plain text").otherwise(lang)))

    def of_lines(lines: Column) -> Column:
        fences = F.filter(upto(F.size(lines)), lambda i: F.startswith(F.get(lines, i), F.lit("```")))
        # every second fence closes; the last may be open
        code = lambda found: F.transform(
            F.filter(found, lambda f, i: i % 2 == 0), lambda f, i: F.struct(f.alias("from"), F.coalesce(F.get(found, 2 * i + 1) + 1, F.size(lines)).alias("to"))
        )
        return let(let(fences, code), lambda cuts: pieces(lines, cuts, between, fenced))

    def of_text(plain: Column) -> Column:
        closing = F.instr(plain, "\n---\n")
        has_head = F.startswith(plain, F.lit("---\n")) & (closing > 0)
        head = F.substr(plain, F.lit(5), F.greatest(closing - 5, F.lit(0)))
        front = F.array(block("heading", F.lit("Frontmatter"), 3), block("code", F.regexp_replace(F.regexp_replace(head, r"\A\n+", ""), r"\n+\z", ""), 0, "yaml"))
        body = F.when(has_head, F.substr(plain, closing + 5, F.length(plain))).otherwise(plain)
        return F.concat(F.when(has_head, front).otherwise(F.array().cast(f"array<{BLOCK}>")), let(F.split(body, "\n"), of_lines))

    return let(F.regexp_replace(F.coalesce(text, F.lit("")), "\r\n?", "\n"), of_text)
