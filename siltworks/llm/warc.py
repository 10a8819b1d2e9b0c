"""Web archives: write WARC/1.1 files, read their records, assemble captures.

:func:`write_archives` writes a request, a response or revisit, and a metadata
record for each page; request and metadata name the response in
``WARC-Concurrent-To``. Records are gzip members of their own, written by Spark's
text writer, so files go wherever Spark can write and a failed task leaves none:
the writer puts one byte behind each row, and a member's last byte, the high byte
of its length, is a zero that it can put there (records of 16 MB and more are
cut into several members).

:func:`read_records` reads archives of any origin, packed or plain, record by
record. :func:`captures` joins request, response and metadata records through the
identifiers of ``WARC-Concurrent-To`` and gives one nested row a capture.

Of pages with equal payloads, the one with the largest page_id is the response
and the others are revisits of it (identical payload digest). Nulls: a null html
is an empty payload; a null page_id is smaller than any, and where a group has no
other, all its rows are responses; a null url is archived as ``about:blank``.
Rows that share the largest page_id are all responses; equal rows have equal
record ids and one capture each. Broken archives give a row with ``problem`` and
nothing after it from that file; of files without records come no rows.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siltworks.llm.shared import drop_kept, keep

END = b"\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: Uncompressed bytes of a gzip member; below 2^24, so that the last byte of its length is 0.
MEMBER = 1 << 23
#: Records of one file.
FILE_RECORDS = 60_000
#: A key with at least this share of all rows is a hot one: there are at most 1 / HOT of them.
HOT = 0.001


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def looked_up(rows: DataFrame, key: str, groups: DataFrame, value: str) -> DataFrame:
    """``rows`` with ``value`` of their key; ``groups`` has (key, value, n), n the rows of a key, and each key once.

    Keys with a thousandth of the rows or more, at most a thousand of them, are
    broadcast; their rows are spread by a salt that meets nothing. The others join by key.
    """
    total = groups.agg(F.sum("n")).first()[0] or 0
    hot = F.broadcast(groups.where(F.col("n") >= max(2, HOT * total)).select(F.col(key).alias("__hot_key"), F.col(value).alias("__hot"), F.lit(True).alias("__is_hot")))
    marked = rows.join(hot, F.col(key) == F.col("__hot_key"), "left")
    salted = F.when(F.col("__is_hot"), F.concat(F.lit("hot "), F.xxhash64(*rows.columns).cast("string"))).otherwise(F.col(key))
    cold = groups.where(F.col("n") < max(2, HOT * total)).select(F.col(key).alias("__key"), F.col(value).alias("__cold"))
    both = marked.withColumn("__key", salted).join(cold, "__key", "left")
    return both.select(*rows.columns, F.coalesce("__hot", "__cold").alias(value))


def record_id(kind: str, *of: Column) -> Column:
    """A URN that depends on the kind of record and some columns."""
    h = F.md5(F.concat_ws("\x1f", F.lit(kind), *(F.coalesce(c.cast("string"), F.lit("\x1e")) for c in of)))
    return F.concat(F.lit("<urn:uuid:"), F.regexp_replace(h, r"^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5"), F.lit(">"))


def uri(url: str | None) -> str:
    """A url as a header may have it: no white space or control characters."""
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url or "") or "about:blank"


def record(headers: list[tuple[str, str | None]], block: bytes) -> bytes:
    lines = ["WARC/1.1", *(f"{k}: {v}" for k, v in headers if v is not None), f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + END + block + END


def members(data: bytes) -> Iterator[bytes]:
    for at in range(0, len(data), MEMBER):
        packer = zlib.compressobj(6, zlib.DEFLATED, 31)
        yield packer.compress(data[at : at + MEMBER]) + packer.flush()


def capture_records(page_id, url, html: bytes, ids: tuple, digest: str, date: str, refers: tuple | None) -> Iterator[bytes]:
    """The three records of one page; ``refers`` has the record id, the page id and the url of the response that a revisit repeats."""
    response, request, about = ids
    target = uri(url)
    host, _, path = target.partition("://")[2].partition("/")
    asked = f"GET /{path.partition('#')[0]} HTTP/1.1\r\nHost: {re.split('[?#]', host)[0]}\r\n\r\n".encode()
    common = [("WARC-Date", date), ("WARC-Target-URI", target)]
    yield record([("WARC-Type", "request"), ("WARC-Record-ID", request), *common, ("WARC-Concurrent-To", response), ("Content-Type", "application/http;msgtype=request")], asked)
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(html)}\r\n\r\n".encode()
    repeats = [("WARC-Profile", PROFILE), ("WARC-Refers-To", refers[0]), ("WARC-Refers-To-Target-URI", uri(refers[2])), ("WARC-Refers-To-Date", date)] if refers else []
    kind = [("WARC-Type", "revisit" if refers else "response"), ("WARC-Record-ID", response), *common, ("WARC-Payload-Digest", f"sha1:{digest}"), *repeats]
    yield record([*kind, ("Content-Type", "application/http;msgtype=response")], head if refers else head + html)
    fields = "".join(f"{k}: {v}\r\n" for k, v in (("pageId", page_id), ("payloadBytes", len(html))) if v is not None).encode()
    yield record([("WARC-Type", "metadata"), ("WARC-Record-ID", about), *common, ("WARC-Concurrent-To", response), ("Content-Type", "application/warc-fields")], fields)


def write_archives(pages: DataFrame, path: str, date: str = "2024-01-01T00:00:00Z", repeats_from: int = 0, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> None:
    """Write the pages as WARC files to a new folder; equal payloads of at least ``repeats_from`` bytes are written once."""
    payload = F.coalesce(F.col(html_col).cast("binary"), F.lit(b""))
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"), payload.alias("html")).withColumn("digest", F.sha1("html"))
    long_enough = rows.where(F.octet_length("html") >= repeats_from)
    first = keep(long_enough.groupBy("digest").agg(F.max(F.struct("page_id", "url")).alias("first"), F.count("*").alias("n")), "warc-payloads")
    # groups of one page need no look-up; they only count for the total
    found = looked_up(rows, "digest", first.select("digest", F.when(F.col("n") > 1, F.col("first")).alias("first"), "n"), "first")
    is_revisit = F.coalesce(F.col("first.page_id") != F.coalesce("page_id", F.col("first.page_id") - 1), F.lit(False)) & (F.octet_length("html") >= repeats_from)
    own = [record_id(kind, F.col("page_id"), F.col("url"), F.col("digest")) for kind in ("response", "request", "metadata")]
    refers = F.when(is_revisit, F.struct(record_id("response", F.col("first.page_id"), F.col("first.url"), F.col("digest")).alias("id"), F.col("first.page_id").alias("page_id"), F.col("first.url").alias("url")))
    todo = found.select("page_id", "url", "html", "digest", *(c.alias(f"id{i}") for i, c in enumerate(own)), refers.alias("refers"))

    def write(batches):
        for b in batches:
            for i in range(b.num_rows):
                page_id, url, html, digest, a, r, m, refers = (c[i].as_py() for c in b.columns)
                bare = base64.b32encode(bytes.fromhex(digest)).decode()
                of = (refers["id"], refers["page_id"], refers["url"]) if refers else None
                # the text writer puts the zero back that ends each member
                packed = [x[:-1] for x in (p for data in capture_records(page_id, url, html, (a, r, m), bare, date, of) for p in members(data))]
                yield pa.RecordBatch.from_arrays([pa.array(packed, pa.binary())], ["value"])

    packed = todo.mapInArrow(write, "value binary").select(F.col("value").cast("string").alias("value"))
    packed.write.option("lineSep", "\0").option("maxRecordsPerFile", FILE_RECORDS).text(path)
    drop_kept(first)


class Broken(ValueError):
    """An archive does not go on as the format says."""


def unpacked(raw: bytes) -> Iterator[bytes]:
    """The bytes of an archive in pieces; gzip members one after the other, or plain."""
    if raw[:2] != b"\x1f\x8b":
        yield raw
        return
    at = 0
    while at < len(raw):
        unpack = zlib.decompressobj(31)
        while not unpack.eof:
            piece = raw[at : at + (1 << 16)]
            if not piece:
                raise Broken("a gzip member is cut off")
            try:
                yield unpack.decompress(piece)
            except zlib.error as e:
                raise Broken("a gzip member is damaged") from e
            at += len(piece) - len(unpack.unused_data)


class Stream:
    """Takes stretches off the front of some pieces."""

    def __init__(self, pieces: Iterator[bytes]):
        self.pieces, self.held = pieces, bytearray()

    def more(self) -> bool:
        piece = next(self.pieces, None)
        self.held += piece or b""
        return piece is not None

    def take(self, size: int) -> bytes:
        while len(self.held) < size:
            if not self.more():
                raise Broken("a record is cut off")
        out = bytes(self.held[:size])
        del self.held[:size]
        return out

    def to(self, mark: bytes) -> bytes:
        looked = 0
        while (at := self.held.find(mark, looked)) < 0:
            looked = max(0, len(self.held) - len(mark))
            if not self.more():
                raise Broken("a header is cut off")
        return self.take(at + len(mark))[: -len(mark)]

    def ended(self) -> bool:
        while not self.held:
            if not self.more():
                return True
        return False


def fields(text: bytes) -> list[tuple[str, str]]:
    """Named fields, a line each; lines that start with white space go on."""
    lines = re.sub(rb"\r?\n[ \t]+", b" ", text).decode("utf-8", "replace").splitlines()
    return [(k.strip(), v.strip()) for k, found, v in (line.partition(":") for line in lines) if found]


def records_of(raw: bytes) -> Iterator[tuple[dict[str, list[str]], bytes]]:
    """Header fields (lower-case names) and block of each record of an archive."""
    stream = Stream(unpacked(raw))
    while not stream.ended():
        version, _, rest = stream.to(END).lstrip(b"\r\n").partition(b"\r\n")
        if not version.startswith(b"WARC/"):
            raise Broken("no record starts here")
        headers: dict[str, list[str]] = {}
        for k, v in fields(rest):
            headers.setdefault(k.lower(), []).append(v)
        size = headers.get("content-length", [""])[0]
        if not re.fullmatch(r"[0-9]+", size):
            raise Broken("a record has no length")
        block = stream.take(int(size))
        if stream.take(4) != END:
            raise Broken("a record is longer than it says")
        yield headers, block


RECORDS = (
    "archive string, position long, type string, record_id string, date string, target_uri string, concurrent_to array<string>, refers_to string, declared_digest string, "
    "payload_bytes long, payload_digest string, http_head string, fields map<string,string>, payload binary, problem string"
)


def read_records(spark: SparkSession, path: str, with_payload: bool = True) -> DataFrame:
    """One row for each record of the archives under a path.

    ``payload`` is the body behind the HTTP head, or the block of a record that is
    not HTTP; ``payload_bytes`` and ``payload_digest`` (bare base32 SHA-1) are of
    what was read, so of an empty payload for a revisit; ``declared_digest`` is what
    the record says. ``fields`` has those of ``application/warc-fields``. A file is
    read as a stream, so a task holds the packed file and one record. (A file that
    Spark's binary files cannot hold, 2 GB, has to be written in parts.)
    """
    names = [x.split()[0] for x in RECORDS.split(", ")]

    def one(archive: str, position: int, headers: dict, block: bytes) -> dict:
        first = lambda k: headers.get(k, [None])[0]
        kind, head, body = first("content-type") or "", None, block
        if kind.startswith("application/http"):
            head, _, body = block.partition(END)
        return {
            "archive": archive, "position": position, "type": first("warc-type"), "record_id": first("warc-record-id"), "date": first("warc-date"), "target_uri": first("warc-target-uri"),
            "concurrent_to": headers.get("warc-concurrent-to", []), "refers_to": first("warc-refers-to"), "declared_digest": (first("warc-payload-digest") or "").removeprefix("sha1:") or None,
            "payload_bytes": len(body), "payload_digest": base32_sha1(body), "http_head": head.decode("utf-8", "replace") if head is not None else None,
            "fields": dict(fields(block)) if kind.startswith("application/warc-fields") else {}, "payload": body if with_payload else None,
        }

    def read(batches):
        schema = pa.schema([(n, t) for n, t in zip(names, TYPES, strict=True)])
        for b in batches:
            for archive, raw in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                rows, held, position = [], 0, 0
                found = records_of(raw.as_buffer().to_pybytes())
                while True:
                    try:
                        row = one(archive, position, *next(found))
                    except StopIteration:
                        break
                    except Broken as e:
                        rows.append({"archive": archive, "position": position, "problem": str(e)})
                        break
                    rows.append(row)
                    position += 1
                    held += len(row["payload"] or b"") + 1000
                    if held > 1 << 23:
                        yield pa.RecordBatch.from_pylist(rows, schema)
                        rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema)

    TYPES = [
        pa.string(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.string(), pa.list_(pa.string()), pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(),
        pa.map_(pa.string(), pa.string()), pa.binary(), pa.string(),
    ]
    return spark.read.format("binaryFile").load(path).select("path", "content").mapInArrow(read, RECORDS)


def captures(records: DataFrame) -> DataFrame:
    """One nested row a capture: (response, request, metadata, n_requests, n_metadata).

    ``response`` is a response, revisit or resource record. Requests and metadata
    come to it by ``WARC-Concurrent-To``, in either direction; a metadata record that
    names a request comes to the request's response. Of several of a kind, the one
    with the smallest record id is given and all are counted. Records without a
    response make a row without one, each by itself; other types are no captures.
    """
    parts = records.where("problem is null")
    main = parts.where(F.col("type").isin("response", "revisit", "resource"))
    side = parts.where(F.col("type").isin("request", "metadata"))
    mains = main.select("record_id").distinct()
    named = F.explode("concurrent_to").alias("of")
    # links of a request or metadata record: those it names, and those that name it
    links = side.select("record_id", named).unionByName(main.select(F.col("record_id").alias("of"), F.explode("concurrent_to").alias("record_id"))).distinct()
    direct = links.join(mains.withColumnRenamed("record_id", "of"), "of", "left_semi")
    # a chain of two: a record that names a request, whose response is known
    passed = links.join(direct.select(F.col("record_id").alias("of"), F.col("of").alias("end")), "of").select("record_id", F.col("end").alias("of"))
    anchors = direct.unionByName(passed).groupBy("record_id").agg(F.min("of").alias("anchor"))
    placed = side.join(anchors, "record_id", "left")
    kinds = []
    for kind in ("request", "metadata"):
        given = placed.where((F.col("type") == kind) & F.col("anchor").isNotNull())
        one = F.min_by(F.struct(*records.columns), F.struct("record_id", "archive", "position")).alias(kind)
        kinds.append(given.groupBy("anchor").agg(one, F.count("*").alias(f"n_{kind}")).withColumnRenamed("anchor", "record_id"))
    whole = main.select("record_id", F.struct(*records.columns).alias("response")).join(kinds[0], "record_id", "left").join(kinds[1], "record_id", "left")
    none = F.lit(None).cast(whole.schema["response"].dataType)
    is_request = F.col("type") == "request"
    loose = placed.where("anchor is null").select(
        none.alias("response"), F.when(is_request, F.struct(*records.columns)).alias("request"), F.when(~is_request, F.struct(*records.columns)).alias("metadata"),
        is_request.cast("long").alias("n_requests"), (~is_request).cast("long").alias("n_metadata"),
    )
    counted = whole.select("response", "request", "metadata", F.coalesce("n_request", F.lit(0)).alias("n_requests"), F.coalesce("n_metadata", F.lit(0)).alias("n_metadata"))
    return counted.unionByName(loose)


def page_captures(spark: SparkSession, path: str) -> DataFrame:
    """The pages of archives by :func:`write_archives`, read back: identity, payload figures, and what a revisit refers to.

    Sizes and digests of responses are those of the payloads as read; of a revisit,
    which has none, those that its records declare.
    """
    records = keep(read_records(spark, path, with_payload=False), "warc-records")
    found = captures(records).where("response is not null")
    page, r = F.col("metadata.fields")["pageId"].cast("long"), F.col("response")
    own = r["type"] == "response"
    rows = found.select(
        page.alias("page_id"), r["target_uri"].alias("target_uri"), F.when(own, r["payload_bytes"]).otherwise(F.col("metadata.fields")["payloadBytes"].cast("long")).alias("payload_bytes"),
        F.when(own, r["payload_digest"]).otherwise(r["declared_digest"]).alias("payload_digest"), r["type"].alias("record_type"), r["record_id"].alias("record_id"), r["refers_to"].alias("of"),
    )
    rows = keep(rows, "warc-captures")
    drop_kept(records)
    counts = rows.where("of is not null").groupBy("of").agg(F.count("*").alias("n"))
    pages = rows.where("record_type = 'response'").groupBy(F.col("record_id").alias("of")).agg(F.max("page_id").alias("refers_to"))
    named = looked_up(rows.where("of is not null"), "of", counts.join(pages, "of"), "refers_to")
    plain = rows.where("of is null").withColumn("refers_to", F.lit(None).cast("long"))
    return named.unionByName(plain).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "target_uri")


