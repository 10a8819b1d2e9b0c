"""Text functions. Built-in expressions where they can say it; chunking as table functions over Arrow batches."""

from __future__ import annotations

import unicodedata
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def clean_title(text: Column) -> Column:
    """A title without a leading date or time and without what follows a hash sign."""
    bare = F.regexp_replace(F.regexp_replace(text, r"^\s*\d{4}[-/.]?\d{2}[-/.]?\d{2}(?:[T _-]*\d{2}:?\d{2}(?::?\d{2})?)?[\s_:-]*", ""), "#.*$", "")
    return F.trim(bare)


def strip_tags(text: Column) -> Column:
    """Without hash tags, white space collapsed."""
    return F.trim(F.regexp_replace(F.regexp_replace(text, r"(^|\s)#[^\s#]+", "$1"), r"\s+", " "))


#: Unicode's space separators.
BLANKS = " \u00a0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u202f\u205f\u3000"


def first_line(text: Column, limit: int = 90) -> Column:
    """The first line that is not blank, without blanks around it, at most ``limit`` characters."""
    # by a lambda: F.trim has a second parameter, which F.transform would give the line's index
    lines = F.filter(F.transform(F.split(text, "\n"), lambda x: F.trim(x, F.lit(BLANKS))), lambda x: x != "")
    return F.left(F.coalesce(F.get(lines, F.lit(0)), F.lit("")), F.lit(limit))


def slug(text: Column, limit: int = 90) -> Column:
    """Lower case words joined by dashes, for ASCII and letters of other scripts."""
    joined = F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]+", "-")
    return F.regexp_replace(F.left(F.regexp_replace(joined, "^-+|-+$", ""), F.lit(limit)), "-+$", "")


def urls(text: Column) -> Column:
    """The http(s) URLs of a text in order, each once, without closing punctuation."""
    found = F.regexp_extract_all(text, F.lit(r"https?://[^\s<>\"')\]]+"), F.lit(0))
    return F.array_distinct(F.transform(found, lambda u: F.regexp_replace(u, r"[.,;:!?]+$", "")))


def redacted_preview(text: Column, limit: int = 180) -> Column:
    """A preview with long digit runs hidden, and short ones too in long texts."""
    hidden = F.regexp_replace(text, r"\b\d{12,19}\b", "[number]")
    hidden = F.when(F.length(text) > 80, F.regexp_replace(hidden, r"\b\d{3,4}\b", "[code]")).otherwise(hidden)
    return F.left(F.trim(F.regexp_replace(hidden, r"\s+", " ")), F.lit(limit))


def front_matter(text: Column) -> Column:
    """The ``key: value`` head of a file as a map; empty without one."""
    head = F.regexp_extract(text, r"(?s)^---\r?\n(.*?)\r?\n---(?:\r?\n|$)", 1)
    lines = F.filter(F.split(head, r"\r?\n"), lambda x: x.rlike(r"^[^:\s][^:]*:"))
    pairs = F.transform(lines, lambda x: F.struct(F.trim(F.substring_index(x, ":", 1)).alias("key"), F.trim(F.regexp_replace(x, "^[^:]*:", "")).alias("value")))
    # of repeated keys the last counts
    last = F.filter(pairs, lambda p, i: ~F.exists(F.slice(pairs, i + 2, F.size(pairs)), lambda q: q["key"] == p["key"]))
    return F.map_from_entries(last)


def render_front_matter(fields: Column) -> Column:
    """A map as a head, keys in order."""
    keys = F.array_sort(F.map_keys(fields))
    return F.concat(F.lit("---\n"), F.array_join(F.transform(keys, lambda k: F.concat(k, F.lit(": "), F.coalesce(F.get(F.filter(F.map_entries(fields), lambda e: e["key"] == k), F.lit(0))["value"], F.lit("")))), "\n"), F.lit("\n---\n"))


def truncate_utf8(text: Column, limit: int) -> Column:
    """At most ``limit`` UTF-8 bytes, cut between characters, without a trailing dash, dot or blank."""
    raw = F.encode(text, "UTF-8")
    lead = lambda k: F.conv(F.hex(F.substring(raw, limit + 1 - k, 1)), 16, 10).cast("int").bitwiseAND(F.lit(0xC0)) != 0x80
    # back up to where a character starts
    cut = F.when(lead(0), limit).when(lead(1), limit - 1).when(lead(2), limit - 2).otherwise(limit - 3)
    kept = F.when(F.octet_length(text) <= limit, text).otherwise(F.decode(F.substr(raw, F.lit(1), cut), "UTF-8"))
    return F.regexp_replace(kept, r"[-. ]+\z", "")


def utf16_units(text: Column) -> Column:
    return (F.octet_length(F.encode(text, "UTF-16LE")) / 2).cast("long")


def html_text(html: Column) -> Column:
    """Rough text of a page: scripts, styles and tags out, common references decoded."""
    bare = F.regexp_replace(html, r"(?is)<(script|style)\b.*?</\1>|<!--.*?-->", " ")
    bare = F.regexp_replace(bare, r"<[^>]*>", " ")
    for name, char in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&nbsp;", " "), ("&amp;", "&")):
        bare = F.replace(bare, F.lit(name), F.lit(char))
    return F.trim(F.regexp_replace(bare, r"\s+", " "))


def mime_of(content: Column) -> Column:
    """MIME type by a file's first bytes."""
    head = F.hex(F.substring(content, 1, 12))
    starts = lambda x: F.startswith(head, F.lit(x))
    return (
        F.when(starts("89504E470D0A1A0A"), "image/png").when(starts("FFD8FF"), "image/jpeg").when(starts("47494638"), "image/gif").when(starts("25504446"), "application/pdf")
        .when(starts("52494646") & (F.substr(head, F.lit(17), F.lit(8)) == "57454250"), "image/webp").when(starts("494433"), "audio/mpeg").when(starts("504B0304"), "application/zip").otherwise("application/octet-stream")
    )


def local_references(text: Column) -> Column:
    """Files that HTML or CSS text refers to: src and href, srcset, url() and @import; each once, those with a scheme or a host left out."""
    found = lambda pattern: F.regexp_extract_all(text, F.lit(pattern), F.lit(1))
    sets = F.flatten(F.transform(found(r"(?i)\bsrcset\s*=\s*[\"']([^\"']+)[\"']"), lambda s: F.transform(F.split(s, r",\s*"), lambda x: F.substring_index(F.trim(x), " ", 1))))
    every = F.concat(found(r"(?i)\b(?:src|href)\s*=\s*[\"']([^\"']+)[\"']"), sets, found(r"(?i)\burl\(\s*[\"']?([^\"')\s]+)"), found(r"(?i)@import\s+[\"']([^\"']+)"))
    return F.array_distinct(F.filter(every, lambda x: ~x.rlike(r"^(?:[A-Za-z][A-Za-z0-9+.-]*:|//|#)") & (x != "")))


def reference(item: Column) -> Column:
    """A list entry's reference as a struct (kind, target, label): wiki link, Markdown link, code, or text."""
    bare = F.trim(F.regexp_replace(item, r"^\s*[-*]\s+", ""))
    part = lambda pattern, i: F.regexp_extract(bare, pattern, i)
    wiki, link, code = r"^\[\[([^\]|#]+)(?:#[^\]|]*)?(?:\|([^\]]+))?\]\]", r"^\[([^\]]*)\]\(([^)]+)\)", r"^`([^`]+)`"
    made = lambda kind, target, label: F.struct(F.lit(kind).alias("kind"), target.alias("target"), F.coalesce(F.nullif(label, F.lit("")), target).alias("label"))
    return (
        F.when(bare.rlike(wiki), made("wiki", part(wiki, 1), part(wiki, 2))).when(bare.rlike(link), made("link", part(link, 2), part(link, 1)))
        .when(bare.rlike(code), made("code", part(code, 1), part(code, 1))).otherwise(made("text", bare, bare))
    )


def normal_body(title: Column, body: Column) -> Column:
    """A body with plain line ends, without leading lines that repeat the title and without runs of blank lines."""
    lines = F.transform(F.split(F.replace(F.regexp_replace(body, "\r\n?", "\n"), F.lit("\\n"), F.lit("\n")), "\n"), lambda x: F.rtrim(x))
    heads = lambda x: (x == "") | (F.trim(F.regexp_replace(x, "^#+ *", "")) == title)
    first = F.get(F.filter(F.transform(lines, lambda x, i: F.when(~heads(x), i)), lambda i: i.isNotNull()), F.lit(0))
    kept = F.array_join(F.slice(lines, F.coalesce(first, F.size(lines)) + 1, F.size(lines)), "\n")
    return F.regexp_replace(F.regexp_replace(kept, "\n{3,}", "\n\n"), "\\s+$", "")


def normal_url(url: Column) -> Column:
    """An http(s) URL with scheme and host in lower case, without www, query, fragment and closing slash; else null."""
    pattern = r"^(?i:(https?)://(?:www\.)?([^/?#]+))([^?#]*?)/?(?:[?#].*)?$"
    part = lambda i: F.regexp_extract(F.trim(url), pattern, i)
    return F.when(url.rlike(pattern), F.concat(F.lower(part(1)), F.lit("://"), F.lower(part(2)), part(3)))


def requested_tags(text: Column, marker: str) -> Column:
    """Tags behind the last ``marker`` of a text, split at punctuation and conjunctions, each once."""
    after = F.when(text.contains(marker), F.substring_index(text, marker, -1)).otherwise("")
    parts = F.transform(F.split(after, r"[,;，、；。.\n]+|\s+and\s+|\s+和\s+"), lambda x: F.trim(F.regexp_replace(F.trim(x), "^#+", "")))
    return F.array_distinct(F.filter(parts, lambda x: x != ""))


def file_name(title: Column, limit: int, empty: str = "untitled") -> Column:
    """A title as a file name: characters that paths keep for themselves become underscores, blanks one, no dot at the end."""
    plain = F.regexp_replace(F.regexp_replace(title, r'[\\/:*?"<>|\x00-\x1f]', "_"), r"\s+", " ")
    plain = F.regexp_replace(F.left(F.trim(plain), F.lit(limit)), r"[. ]+$", "")
    return F.when(F.coalesce(plain, F.lit("")) == "", empty).otherwise(plain)


def escaped_label(text: Column) -> Column:
    """A label whose Markdown marks are escaped."""
    return F.regexp_replace(text, r"([\[\]*_`])", r"\\$1")


def sections(text: Column) -> Column:
    """Sections of a Markdown text as structs (heading, body): what stands before the first heading, then each heading's part."""
    parts = F.split(F.concat(F.lit("\n"), text), r"\n#{1,6} +")
    trimmed = lambda x: F.regexp_replace(F.regexp_replace(x, r"^\s+", ""), r"\s+$", "")
    rest = F.transform(F.slice(parts, F.lit(2), F.size(parts)), lambda p: F.struct(F.trim(F.substring_index(p, "\n", 1)).alias("heading"), trimmed(F.regexp_replace(p, "^[^\n]*", "")).alias("body")))
    first = F.struct(F.lit("").alias("heading"), trimmed(F.get(parts, F.lit(0))).alias("body"))
    return F.when(trimmed(F.get(parts, F.lit(0))) != "", F.concat(F.array(first), rest)).otherwise(rest)


def region(text: Column, start: str, end: str) -> Column:
    """The slot between two markers as a struct (start, length, bytes), start from 1; null unless each marker stands once, in order."""
    once = lambda m: (F.length(text) - F.length(F.replace(text, F.lit(m)))) == len(m)
    begin, stop = F.instr(text, start) + len(start), F.instr(text, end)
    inside = F.substr(text, begin, stop - begin)
    slot = F.struct(begin.cast("long").alias("start"), F.length(inside).cast("long").alias("length"), F.octet_length(inside).cast("long").alias("bytes"))
    return F.when(once(start) & once(end) & (stop >= begin), slot)


def json_outcome(raw: Column, most_bytes: int) -> Column:
    """accepted, too_large, malformed or duplicate_key, for JSON that has to be strict."""
    parsed = F.try_parse_json(raw)
    # a value that is read only when keys may repeat has a key twice
    lenient = F.from_json(raw, "struct<__bad:string>", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "__bad"})["__bad"].isNull()
    return F.when(F.octet_length(raw) > most_bytes, "too_large").when(parsed.isNotNull(), "accepted").when(lenient & raw.isNotNull(), "duplicate_key").otherwise("malformed")


def keywords_in(text: Column, words: tuple[str, ...]) -> Column:
    """Those of the words that occur, in their order: ASCII ones as whole words, others anywhere."""
    low = F.lower(text)
    hit = lambda w: low.rlike(rf"(?<![a-z0-9]){w}(?![a-z0-9])") if w.isascii() else low.contains(w)
    return F.array_compact(F.array(*(F.when(hit(w), w) for w in words)))


#: Characters of pieces that a task gathers before it hands them on.
GATHERED = 1 << 20


def split_rows(df: DataFrame, key: str, text: str, split: Callable[[str], Iterator[str]], out: str = "chunk") -> DataFrame:
    """Rows (key, pos, chunk) from a Python splitter, run over Arrow batches; null and empty texts give no row.

    Texts are taken from a batch one by one and pieces go on by about a million
    characters, so a task holds its input batch, one text and that much of pieces.
    """

    def made(rows, schema):
        keys, places, parts = zip(*rows, strict=True)
        return pa.RecordBatch.from_arrays([pa.array(keys, schema.field(0).type), pa.array(places, pa.int64()), pa.array(parts, pa.string())], [key, "pos", out])

    def run(batches):
        for b in batches:
            rows, size = [], 0
            for k, t in zip(b.column(0), b.column(1), strict=True):
                plain = t.as_py()
                for i, part in enumerate(split(plain) if plain else ()):
                    rows.append((k.as_py(), i, part))
                    size += len(part)
                    if size >= GATHERED:
                        yield made(rows, b.schema)
                        rows, size = [], 0
            if rows:
                yield made(rows, b.schema)

    kind = df.schema[key].dataType.simpleString()
    return df.select(key, text).mapInArrow(run, f"{key} {kind}, pos long, {out} string")


def utf16_chunks(text: str, limit: int = 2000) -> Iterator[str]:
    """Pieces of at most ``limit`` UTF-16 units; a character is never cut."""
    start = units = 0
    for i, char in enumerate(text):
        size = 2 if ord(char) > 0xFFFF else 1
        if units + size > limit:
            yield text[start:i]
            start, units = i, 0
        units += size
    if start < len(text):
        yield text[start:]


def soft_chunks(text: str, limit: int = 1800, least: int = 400) -> Iterator[str]:
    """Pieces of at most ``limit`` characters, cut at a line end or a blank if the piece stays long enough."""
    at = 0
    while len(text) - at > limit:
        cut = text.rfind("\n", at + least, at + limit)
        cut = cut if cut >= 0 else text.rfind(" ", at + least, at + limit)
        end = cut + 1 if cut >= 0 else at + limit
        yield text[at:end]
        at = end
    if at < len(text):
        yield text[at:]


def nfkc_slugs(df: DataFrame, key: str, text: str, limit: int = 120) -> DataFrame:
    """Rows (key, pos, chunk): a slug after compatibility normalisation, at most ``limit`` UTF-8 bytes."""

    def one(t: str) -> Iterator[str]:
        plain = "".join(c if c.isalnum() else "-" for c in unicodedata.normalize("NFKC", t).lower())
        yield "-".join(x for x in plain.split("-") if x).encode()[:limit].decode("utf-8", "ignore").strip("-")

    return split_rows(df, key, text, one)
