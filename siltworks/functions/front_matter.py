"""Front matter in six dialects, each with its own errors: structs (outcome, fields)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from siltworks.functions.markdown import let, strip, upto

#: Keys that say whose record a file is (fixed values).
SCALAR_IDENTITY = ("note_id", "canonicalId", "source_ids.api", "source_system")
OWNER_IDENTITY = ("source_system", "source_type", "page_id", "source_id")
LEGACY_FIELDS = ("note_id", "note_type", "audio_transcript", "web_excerpt")
#: Fields of a migrated file that do not count, and fields that an older file may lack (fixed values).
VOLATILE, ADDED_LATER = ("listened_at", "updated_at", "synced_at"), ("transcript_file_names", "transcript_file_count")

PAIR = "struct<key:string,value:string>"


def head(text: Column, closes: Callable[[Column], Column], body: Callable[[Column], Column], line_end: str = "\n", must_follow: bool = False) -> Column:
    """``body`` of the lines of a head, null without one: a first line of dashes and a later one that ``closes``."""

    def of_lines(lines: Column) -> Column:
        last = F.size(lines) - (1 if must_follow else 0)
        ends = F.filter(upto(F.size(lines)), lambda i: (i > 0) & (i < last) & closes(F.get(lines, i)))
        inner = lambda end: F.when(end.isNotNull() & closes(F.get(lines, F.lit(0))), F.slice(lines, F.lit(2), end - 1))
        return let(let(F.get(ends, F.lit(0)), inner), lambda part: F.when(part.isNotNull(), body(part)))

    return let(F.split(F.coalesce(text, F.lit("")), line_end), of_lines)


def pair(line: Column, by: str = ":") -> Column:
    at = F.instr(line, by)
    return F.struct(F.substr(line, F.lit(1), at - 1).alias("key"), F.substr(line, at + len(by), F.length(line)).alias("value"))


def result(outcome: Column | str, pairs: Column | None = None) -> Column:
    """Of repeated keys the last counts."""
    made = F.array().cast(f"array<{PAIR}>") if pairs is None else pairs
    last = lambda p: F.map_from_entries(F.filter(p, lambda x, i: ~F.exists(F.slice(p, i + 2, F.size(p)), lambda y: y["key"] == x["key"])))
    return F.struct((outcome if isinstance(outcome, Column) else F.lit(outcome)).alias("outcome"), let(made, last).alias("fields"))


def repeated(pairs: Column) -> Column:
    keys = F.transform(pairs, lambda p: p["key"])
    return F.size(F.array_distinct(keys)) < F.size(keys)


def unquoted(value: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(strip(value), r"\A[\"']+|[\"']+\z", ""), r"\A\s+\z", "")


def json_scalar(value: Column) -> Column:
    """A JSON value as Python prints it, else the text without quotes."""
    parsed = F.try_parse_json(value)
    shown = F.to_json(parsed)
    named = F.when(shown == "true", "True").when(shown == "false", "False").when(shown == "null", "None").otherwise(F.try_variant_get(parsed, "$", "string"))
    return F.when(parsed.isNotNull(), named).otherwise(F.regexp_replace(value, r"\A[\"']+|[\"']+\z", ""))


def or_none(found: Column) -> Column:
    return F.coalesce(found, result("none"))


def lenient(text: Column) -> Column:
    """Every line with a colon counts; quotes go."""
    pairs = lambda lines: F.transform(F.filter(lines, lambda x: x.contains(":")), lambda x: F.struct(strip(pair(x)["key"]).alias("key"), unquoted(pair(x)["value"]).alias("value")))
    return or_none(head(text, lambda x: strip(x) == "---", lambda lines: result("ok", pairs(lines)), r"\r?\n"))


def scalars(text: Column) -> Column:
    """JSON scalars, and the members of ``source_ids`` by dotted names; ``conflict`` where a key of identity has two values."""

    def body(lines: Column) -> Column:
        keyed = F.filter(lines, lambda x: x.contains(":"))
        parent = lambda i: F.try_element_at(F.filter(F.slice(keyed, F.lit(1), i), lambda y: ~F.startswith(y, F.lit(" "))), F.lit(-1))

        def one(line: Column, i: Column) -> Column:
            p = pair(line)
            nested = F.startswith(line, F.lit("  ")) & F.coalesce(parent(i).rlike(r"\Asource_ids:\s*\z"), F.lit(False))
            return F.struct(F.when(nested, F.concat(F.lit("source_ids."), strip(p["key"]))).otherwise(p["key"]).alias("key"), json_scalar(strip(p["value"])).alias("value"))

        clash = lambda ps: F.exists(ps, lambda a: a["key"].isin(*SCALAR_IDENTITY) & F.exists(ps, lambda b: (b["key"] == a["key"]) & (b["value"] != a["value"])))
        return let(F.transform(keyed, one), lambda ps: F.when(clash(ps), result("conflict")).otherwise(result("ok", ps)))

    return or_none(F.when(F.startswith(text, F.lit("---\n")), head(text, lambda x: strip(x) == "---", body)))


def strict_json(text: Column) -> Column:
    """Each line is a key of its own and one JSON value; anything else is ``malformed``. Values stay JSON."""

    def body(lines: Column) -> Column:
        good = F.forall(lines, lambda x: x.contains(": ") & F.try_parse_json(pair(x, ": ")["value"]).isNotNull())
        return let(F.transform(lines, lambda x: pair(x, ": ")), lambda ps: F.when(good & ~repeated(ps), result("ok", ps)).otherwise(result("malformed")))

    return F.coalesce(head(text, lambda x: x == "---", body, must_follow=True), result("malformed"))


def owner(text: Column, system: str, kind: str) -> Column:
    """Only the keys of identity: ``duplicate``, ``unsupported`` quoting, ``foreign`` (another owner), or ``ok``."""

    def body(lines: Column) -> Column:
        own = F.filter(lines, lambda x: (x != "") & ~x.rlike(r"\A[\s#]") & x.contains(":"))

        def one(line: Column) -> Column:
            v = strip(pair(line)["value"])
            text_of = F.try_variant_get(F.try_parse_json(v), "$", "string")
            single = F.when(v.rlike(r"\A'(?:[^']|'')*+'\z"), F.replace(F.substr(v, F.lit(2), F.length(v) - 2), F.lit("''"), F.lit("'")))
            plain = strip(F.substring_index(v, " #", 1))
            return F.struct(pair(line)["key"].alias("key"), F.when(F.startswith(v, F.lit('"')), text_of).when(F.startswith(v, F.lit("'")), single).otherwise(plain).alias("value"))

        named = lambda ps: F.filter(ps, lambda p: p["key"].isin(*OWNER_IDENTITY))
        has = lambda ps, k, v: F.exists(ps, lambda p: (p["key"] == k) & (p["value"] == v))

        def judged(ps: Column) -> Column:
            kept = named(ps)
            return (
                F.when(F.exists(ps, lambda p: p["value"].isNull()), result("unsupported")).when(repeated(kept), result("duplicate"))
                .when(~has(ps, "source_system", system) | ~has(ps, "source_type", kind), result("foreign")).otherwise(result("ok", kept))
            )

        return let(F.transform(own, one), judged)

    return or_none(head(F.regexp_replace(text, "\\A\ufeff", ""), lambda x: F.regexp_replace(x, r"\s+\z", "") == "---", body, r"\r?\n"))


def continued(text: Column) -> Column:
    """Raw values that go on in indented lines; ``unknown`` lines and ``duplicate`` keys are errors."""

    def body(lines: Column) -> Column:
        more = lambda i: F.startswith(F.get(lines, i), F.lit("  "))
        begins = F.filter(upto(F.size(lines)), lambda i: (i == 0) | ~more(i))
        part = lambda starts: F.transform(starts, lambda s, at: F.array_join(F.slice(lines, s + 1, F.coalesce(F.get(starts, at + 1), F.size(lines)) - s), "\n"))
        good = lambda whole: F.forall(whole, lambda w: F.substring_index(w, "\n", 1).contains(": "))
        pairs = lambda whole: F.transform(whole, lambda w: pair(w, ": "))
        judged = lambda whole: F.when(~good(whole), result("unknown")).otherwise(let(pairs(whole), lambda ps: F.when(repeated(ps), result("duplicate")).otherwise(result("ok", ps))))
        return let(let(begins, part), judged)

    return F.coalesce(head(text, lambda x: x == "---", body, must_follow=True), result("unknown"))


def legacy(text: Column) -> Column:
    """Flat scalars only: an indented, empty or comment line, a repeated key or a list is ``malformed``; a few fields are given."""

    def body(lines: Column) -> Column:
        flat = F.forall(lines, lambda x: ~x.rlike(r"\A(?:\s|#|\z)") & x.contains(":"))

        def one(line: Column) -> Column:
            v = strip(pair(line)["value"])
            text_of = F.when(F.startswith(F.to_json(F.try_parse_json(v)), F.lit('"')), F.try_variant_get(F.try_parse_json(v), "$", "string"))
            single = F.when((F.length(v) > 0) & F.endswith(v, F.lit("'")), F.replace(F.regexp_replace(v, r"\A'|'\z", ""), F.lit("''"), F.lit("'")))
            plain = F.when(~v.rlike(r"\A(?:[|>]\z|[&*!\[{])"), v)
            return F.struct(pair(line)["key"].alias("key"), F.when(F.startswith(v, F.lit('"')), text_of).when(F.startswith(v, F.lit("'")), single).otherwise(plain).alias("value"))

        def judged(ps: Column) -> Column:
            given = F.filter(ps, lambda p: p["key"].isin(*LEGACY_FIELDS))
            return F.when(~flat | repeated(ps) | F.exists(given, lambda p: p["value"].isNull()), result("malformed")).otherwise(result("ok", given))

        return let(F.transform(lines, one), judged)

    return F.coalesce(head(text, lambda x: x == "---", body, must_follow=True), result("malformed"))


def migration_equal(before: Column, after: Column) -> Column:
    """Whether a migrated file is the old one but for its volatile fields and fields it gained; null where either is no such file."""
    old, new = continued(before), continued(after)
    body = lambda t: F.substr(t, F.instr(t, "\n---\n") + 5, F.length(t))
    steady = lambda m: F.map_filter(m, lambda k, _: ~k.isin(*VOLATILE))
    comparable = F.map_filter(steady(new["fields"]), lambda k, _: ~k.isin(*ADDED_LATER) | F.map_contains_key(old["fields"], k))
    entries = lambda m: F.array_sort(F.map_entries(m))
    return F.when((old["outcome"] == "ok") & (new["outcome"] == "ok"), (entries(steady(old["fields"])) == entries(comparable)) & (body(before) == body(after)))
