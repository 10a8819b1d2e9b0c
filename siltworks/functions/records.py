"""Typed properties, canonical JSON of nested values, attachments and their stable versions."""

from __future__ import annotations

from collections.abc import Collection

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StructType


def plain_property(prop: Column) -> Column:
    """The plain value of a typed property in JSON, as text; lists and relations as JSON; null for an unknown kind.

    Kinds: title, rich_text, number, checkbox, select, status, multi_select, date,
    url, email, phone_number, people, relation, files, formula, rollup.
    """
    at = lambda path: F.get_json_object(prop, path)
    kind = at("$.type")
    text = lambda k: F.array_join(F.transform(F.from_json(at(f"$.{k}"), "array<struct<plain_text:string>>"), lambda x: F.coalesce(x["plain_text"], F.lit(""))), "")
    items = lambda k: F.from_json(at(f"$.{k}"), "array<struct<id:string,name:string,type:string>>")
    present = lambda a: F.to_json(F.filter(a, lambda x: F.coalesce(x, F.lit("")) != ""))
    start, end = (F.coalesce(at(f"$.date.{x}"), F.lit("")) for x in ("start", "end"))
    dates = F.when((start != "") & (end != "") & (start != end), F.concat(start, F.lit(" → "), end)).when(start != "", start).otherwise(end)
    ids = F.filter(F.transform(items("relation"), lambda x: x["id"]), lambda x: F.coalesce(x, F.lit("")) != "")
    out = F.when(kind.isin("title"), text("title")).when(kind == "rich_text", text("rich_text"))
    out = out.when(kind == "checkbox", F.coalesce(at("$.checkbox"), F.lit("false")))
    for k in ("select", "status"):
        out = out.when(kind == k, at(f"$.{k}.name"))
    out = out.when(kind == "multi_select", present(F.transform(items("multi_select"), lambda x: x["name"])))
    out = out.when(kind == "date", F.when(at("$.date").isNotNull(), dates))
    out = out.when(kind == "people", present(F.transform(items("people"), lambda x: F.coalesce(F.nullif(x["name"], F.lit("")), x["id"]))))
    out = out.when(kind == "relation", F.to_json(F.struct(F.size(ids).alias("count"), ids.alias("ids"))))
    out = out.when(kind == "files", F.to_json(F.transform(items("files"), lambda x: F.coalesce(F.nullif(x["name"], F.lit("")), F.nullif(x["type"], F.lit("")), F.lit("file")))))
    for k in ("number", "url", "email", "phone_number"):
        out = out.when(kind == k, at(f"$.{k}"))
    for k in ("formula", "rollup"):
        inner = at(f"$.{k}.type")
        value = F.coalesce(*(F.when(inner == t, at(f"$.{k}.{t}")) for t in ("string", "number", "boolean", "date", "array")))
        out = out.when(kind == k, value)
    return out


def canonical(value: Column, kind: DataType, without: Collection[str] = ()) -> Column:
    """A nested value with the fields of its structs in alphabetical order, less those named in ``without``, at any depth."""
    if isinstance(kind, StructType):
        fields = sorted((f for f in kind.fields if f.name not in without), key=lambda f: f.name)
        return F.when(value.isNotNull(), F.struct(*(canonical(value[f.name], f.dataType, without).alias(f.name) for f in fields)))
    if isinstance(kind, ArrayType):
        return F.transform(value, lambda x: canonical(x, kind.elementType, without))
    if isinstance(kind, MapType):
        kept = F.filter(F.map_entries(value), lambda e: ~e["key"].isin(*without)) if without else F.map_entries(value)
        return F.map_from_entries(F.transform(F.array_sort(kept, lambda a, b: F.when(a["key"] < b["key"], -1).otherwise(1)), lambda e: F.struct(e["key"], canonical(e["value"], kind.valueType, without))))
    return value


def canonical_text(value: Column, kind: DataType, without: Collection[str] = ()) -> Column:
    """Compact JSON of :func:`canonical`, nulls kept."""
    return F.to_json(canonical(value, kind, without), {"ignoreNullFields": "false"})


def strings_of(value: Column, kind: DataType) -> Column:
    """All strings of a nested value in order, empty ones left out."""
    none = F.array().cast("array<string>")
    if isinstance(kind, StructType):
        return F.flatten(F.array(*(strings_of(value[f.name], f.dataType) for f in kind.fields))) if kind.fields else none
    if isinstance(kind, ArrayType):
        return F.coalesce(F.flatten(F.transform(value, lambda x: strings_of(x, kind.elementType))), none)
    if isinstance(kind, MapType):
        return F.coalesce(F.flatten(F.transform(F.map_values(value), lambda x: strings_of(x, kind.valueType))), none)
    return F.filter(F.array(value), lambda x: F.coalesce(x, F.lit("")) != "") if kind.typeName() == "string" else none


def stable_asset_url(url: Column, host: str, names: Collection[str]) -> Column:
    """A URL of ``host`` less the signing parameters if it has all of them, each once; any other URL as it is."""
    fits = F.lower(F.regexp_extract(url, r"^https?://([^/?#]*)", 1)) == host
    for n in names:
        fits = fits & (F.regexp_count(url, F.lit(f"[?&]{n}=")) == 1)
    bare = F.regexp_replace(url, f"(?<=[?&])(?:{'|'.join(names)})=[^&#]*(?:&|(?=#|$))", "")
    return F.when(fits, F.regexp_replace(bare, r"[?&](?=#|$)", "")).otherwise(url)


def first_in_window(evidence: list[tuple[str, Column]], start: str, end: str) -> Column:
    """The first (field, day) of ordered evidence whose day lies in the window, ends included; else null.

    A field outside the window is passed over; it does not decide."""
    all_of = F.array(*(F.struct(F.lit(name).alias("field"), day.alias("day")) for name, day in evidence))
    inside = F.filter(all_of, lambda x: x["day"].between(F.lit(start).cast("date"), F.lit(end).cast("date")))
    return F.get(inside, F.lit(0))


def preferred(fields: Column, keys: Collection[str], limit: int) -> Column:
    """Up to ``limit`` names of non-empty values of a string map: preferred ones in order, then others by name."""
    filled = F.map_filter(fields, lambda k, v: F.coalesce(v, F.lit("")) != "")
    first = F.filter(F.array(*map(F.lit, keys)), lambda k: F.map_contains_key(filled, k))
    return F.slice(F.array_union(first, F.array_sort(F.map_keys(filled))), 1, limit)


def needs_assets(kinds: Column, note_type: Column, content: Column) -> Column:
    """Whether a note's binaries must be fetched: an attachment that is no link, a recorded note, or an image in its text."""
    return F.exists(kinds, lambda k: k != "link") | note_type.isin("audio", "recorder") | content.contains("![")


def missing_fields(before: Column, after: Column) -> Column:
    """Keys of a string map that had a value and have none now."""
    lost = F.map_filter(before, lambda k, v: (F.coalesce(v, F.lit("")) != "") & (F.coalesce(F.try_element_at(after, k), F.lit("")) == ""))
    return F.array_sort(F.map_keys(lost))


def tag_names(tags: Column) -> Column:
    """Names of tags given as strings or as objects with a name, in JSON: trimmed, each once, in order."""
    each = F.from_json(tags, "array<string>")
    name = lambda t: F.trim(F.coalesce(F.when(t.startswith("{"), F.get_json_object(t, "$.name")).otherwise(t), F.lit("")))
    return F.array_distinct(F.filter(F.transform(each, name), lambda x: x != ""))
