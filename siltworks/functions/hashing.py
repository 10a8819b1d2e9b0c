"""Hashes and canonical text of nested values."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def stable_url(url: Column) -> Column:
    """A URL less its query and fragment, which signed links change at each reading."""
    return F.regexp_replace(F.regexp_replace(url, "#.*$", ""), "[?].*$", "")


def without_signature(url: Column, *names: str) -> Column:
    """A URL less the signing parameters, if it has them all; else the URL as it is."""
    has_all = F.lit(True)
    for n in names:
        has_all = has_all & url.rlike(f"[?&]{n}=")
    bare = F.regexp_replace(url, f"(?<=[?&])(?:{'|'.join(names)})=[^&#]*&?", "")
    return F.when(has_all, F.regexp_replace(bare, r"[?&](?=#|$)", "")).otherwise(url)


def canonical_json(**fields: Column) -> Column:
    """Compact JSON of the fields in alphabetical order, nulls kept."""
    return F.to_json(F.struct(*(fields[k].alias(k) for k in sorted(fields))), {"ignoreNullFields": "false"})


def blob_sha1(content: Column) -> Column:
    """The SHA-1 that version control names a file's content by."""
    raw = F.encode(content, "UTF-8")
    return F.sha1(F.concat(F.encode(F.concat(F.lit("blob "), F.octet_length(raw).cast("string")), "UTF-8"), F.unhex(F.lit("00")), raw))


def hmac_sha256(key: bytes, message: Column) -> Column:
    """Keyed hash (RFC 2104) of a text."""
    import hashlib

    block = (hashlib.sha256(key).digest() if len(key) > 64 else key).ljust(64, b"\0")
    pad = lambda x: F.unhex(F.lit(bytes(b ^ x for b in block).hex()))
    inner = F.unhex(F.sha2(F.concat(pad(0x36), F.encode(message, "UTF-8")), 256))
    return F.sha2(F.concat(pad(0x5C), inner), 256)
