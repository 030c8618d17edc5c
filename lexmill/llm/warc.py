"""WARC archives: written from pages, read back, and assembled into captures.

Every capture has three records: a request, a response (or a revisit of an
earlier response with the same payload) and a metadata record.  The first and the last
name the record between them by WARC-Concurrent-To.  Each record is a gzip
member of its own, so an archive can be cut at any record.

Spark's own writer and reader for text do the storage, by Hadoop's file systems: a capture is a
line of bytes, and the end of a line is an empty gzip member (GAP), which any
reader of gzip passes over and which can't occur within a member.  So files are committed as any table's are,
a task that runs twice leaves no second file, and large files are
read in splits.  An archive's files are named `part-*`; their content is WARC.

Reading: lines are cut into records, payload digests are computed anew, and the
three record types are joined by their identifiers into one nested row.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from functools import partial

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from .common import count_of, cut, shared_dir, sliced

DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORD = "id string, type string, concurrent_to string, refers_to string, uri string, digest string, http_status int, declared_bytes long, payload_bytes long, payload_digest string, fields map<string,string>, payload binary"
#: Fixed value: a gzip member without content, as characters of one byte each.
GAP = "\x1f\x8b\x08\x00\x00\x00\x00\x00\x00\x03\x03\x00\x00\x00\x00\x00\x00\x00\x00\x00"
LINES = {"lineSep": GAP, "encoding": "ISO-8859-1"}
#: Payloads that more than one row holds, up to so many, are sent to all executors (60 bytes each).
MAX_SENT_REPEATS = 300_000


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(headers: dict[str, str], block: bytes) -> bytes:
    """One WARC record as a gzip member."""
    lines = [b"WARC/1.1", *(f"{k}: {v}".encode() for k, v in headers.items()), b"Content-Length: %d" % len(block), b"", b""]
    pack = zlib.compressobj(1, zlib.DEFLATED, 31)
    return pack.compress(b"\r\n".join(lines) + block + b"\r\n\r\n") + pack.flush()


def _clean(value: str | None) -> str:
    """A header value: without line breaks."""
    return " ".join((value or "").split())


def name_of(run: str, *parts) -> str:
    """A record id that depends on the archive and on `parts` alone."""
    return f"<urn:uuid:{uuid.uuid5(uuid.UUID(run), '|'.join(map(str, parts)))}>"


def capture(run: str, serial: str, page_id: int | None, url: str | None, payload: bytes, first: int | None, single: bool) -> bytes:
    """The three records of a capture; first: the page whose response it revisits; single: no other response has this page and payload."""
    uri = _clean(url) or "urn:lexmill:no-url"
    path = uri.split("://", 1)[-1].partition("/")[2].partition("#")[0]
    host = uri.split("://", 1)[-1].partition("/")[0]
    mark = digest(payload)
    # a page that is there twice with one payload has no single response, so others can't name it
    own = first is None and single and page_id is not None
    name = name_of(run, "response", page_id, mark) if own else name_of(run, "capture", serial)
    common = {"WARC-Date": DATE, "WARC-Target-URI": uri}
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    ask = f"GET /{path} HTTP/1.1\r\nHost: {host}\r\n\r\n".encode()
    fields = "".join(f"{k}: {v}\r\n" for k, v in (("pageId", page_id), ("refersToPage", first), ("hasUrl", int(url is not None))) if v is not None)
    about = {"WARC-Payload-Digest": f"sha1:{mark}", "Content-Type": "application/http; msgtype=response"}
    if first is None:
        body = record({"WARC-Type": "response", "WARC-Record-ID": name, **common, **about}, http + payload)
    else:
        seen = {"WARC-Profile": PROFILE} | ({"WARC-Refers-To": name_of(run, "response", first, mark)} if single else {})
        body = record({"WARC-Type": "revisit", "WARC-Record-ID": name, **common, **about, **seen}, http)
    near = {"WARC-Concurrent-To": name}
    request = record({"WARC-Type": "request", "WARC-Record-ID": name_of(run, "request", serial), **common, **near, "Content-Type": "application/http; msgtype=request"}, ask)
    meta = record({"WARC-Type": "metadata", "WARC-Record-ID": name_of(run, "metadata", serial), **common, **near, "Content-Type": "application/warc-fields"}, fields.encode())
    return request + body + meta


def _write(batches, run: str) -> Iterator[pa.RecordBatch]:
    """The captures of (page_id, url, html, first, single) as bytes, one a row."""
    part, serial = TaskContext.get().partitionId(), 0
    for batch in batches:
        for piece in sliced(batch, "html"):
            out = []
            for page, url, html, first, single in zip(*(piece.column(k).to_pylist() for k in range(5)), strict=True):
                out.append(capture(run, f"{part}-{serial}", page, url, (html or "").encode(), first, single))
                serial += 1
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["value"])


def write(pages: DataFrame, folder: str) -> int:
    """Writes the archives of `pages` to a new folder; returns the number of captures.

    Of rows with equal payloads those with the smallest page_id become responses,
    the others revisits of it.  A row without page_id is a revisit if any row with a page_id
    holds its payload, else a response.  Pages are moved only to find the
    revisits of payloads that more rows hold than fit a broadcast.
    """
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.coalesce(pages["html"].cast("string"), F.lit("")).alias("html"), F.sha2(F.coalesce(pages["html"].cast("string"), F.lit("")), 256).alias("mark"))
    held = rows.groupBy("mark", "page_id").agg(F.count(F.lit(1)).alias("n"))
    named = F.when(F.col("page_id").isNotNull(), F.struct("page_id", "n"))
    repeats = cut(held.groupBy("mark").agg(F.min(named).alias("first"), F.sum("n").alias("rows")).where("rows > 1 and first is not null").select(F.col("mark").alias("_mark"), "first"))
    if count_of(repeats) <= MAX_SENT_REPEATS:
        repeats = F.broadcast(repeats)
    other = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first.page_id"))
    known = rows.join(repeats, F.col("mark") == F.col("_mark"), "left").select("page_id", "url", "html", F.when(other, F.col("first.page_id")).alias("first"), F.coalesce(F.col("first.n") == 1, F.lit(True)).alias("single"))
    seen = Observation()
    lines = known.mapInArrow(partial(_write, run=str(uuid.uuid4())), "value binary").observe(seen, F.count(F.lit(1)).alias("n"))
    lines.select(F.col("value").cast("string").alias("value")).write.options(**LINES).text(folder)
    return seen.get["n"]


def _members(data: bytes) -> Iterator[tuple]:
    view = memoryview(data)
    at = 0
    while at < len(view):
        # a member of usual size is unpacked from a small window, so that the rest isn't copied each time
        window = 1 << 16
        while True:
            unpack = zlib.decompressobj(31)
            raw = unpack.decompress(view[at : at + window])
            if unpack.eof:
                at += min(window, len(view) - at) - len(unpack.unused_data)
                break
            if at + window >= len(view):
                raise ValueError("the archive ends within a record")
            window *= 4
        if raw:
            yield raw


def records(data: bytes) -> Iterator[tuple]:
    """The records of an archive, as RECORD."""
    for raw in _members(data):
        head, _, rest = raw.partition(b"\r\n\r\n")
        lines = head.decode("utf-8", "replace").split("\r\n")
        h = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
        block = rest[: int(h["content-length"])]
        kind = h["warc-type"]
        fields: dict[str, str] = {}
        payload, status, size = None, None, None
        if kind in ("response", "revisit", "request"):
            http, _, payload = block.partition(b"\r\n\r\n")
            top, *more = http.decode("utf-8", "replace").split("\r\n")
            status = int(top.split(" ")[1]) if kind != "request" else None
            size = next((int(x.partition(":")[2]) for x in more if x.lower().startswith("content-length:")), None)
            payload = payload if kind == "response" else None
        elif kind == "metadata":
            fields = {k.strip(): v.strip() for k, _, v in (x.partition(":") for x in block.decode("utf-8", "replace").split("\r\n") if x)}
        mark = h.get("warc-payload-digest", "").removeprefix("sha1:") or None
        yield h["warc-record-id"], kind, h.get("warc-concurrent-to"), h.get("warc-refers-to"), h.get("warc-target-uri"), mark, status, size, None if payload is None else len(payload), None if payload is None else digest(payload), list(fields.items()), payload


def _read(batches, payload: bool) -> Iterator[pa.RecordBatch]:
    types = [pa.string()] * 6 + [pa.int32(), pa.int64(), pa.int64(), pa.string(), pa.map_(pa.string(), pa.string()), pa.binary()]
    names = [x.split()[0] for x in RECORD.split(", ")]

    def packed(held: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held, strict=True), types, strict=True)], names=names)

    for batch in batches:
        held: list[tuple] = []
        size = 0
        for line in batch.column(0):
            for r in records(line.as_py()):
                held.append(r if payload else (*r[:-1], None))
                size += len(held[-1][-1] or b"") + 500
                if size > 1 << 21:
                    yield packed(held)
                    held, size = [], 0
        if held:
            yield packed(held)


def read(spark: SparkSession, folder: str, payload: bool = True) -> DataFrame:
    """All records of the archives in a folder; without `payload` that column is null, its length and digest are there."""
    lines = spark.read.options(**LINES).text(folder)
    return lines.select(F.col("value").cast("binary").alias("value")).mapInArrow(partial(_read, payload=payload), RECORD)


def captures(records: DataFrame) -> DataFrame:
    """One nested row per capture: uri, response, request and metadata, joined by WARC-Concurrent-To.

    response.intact says that the payload read back has the digest declared (null for a revisit, which has none).
    A capture without request or metadata has null there; request and metadata records
    of no known response are left out.  The records are read three times, unless they were cut before.
    """
    main = records.where("type in ('response', 'revisit')")
    asked = records.where("type = 'request'").select(F.col("concurrent_to").alias("id"), F.struct(F.col("id").alias("id")).alias("request"))
    about = records.where("type = 'metadata'").select(F.col("concurrent_to").alias("id"), F.struct(F.col("id").alias("id"), "fields").alias("metadata"))
    intact = ((F.col("payload_digest") == F.col("digest")) & (F.col("payload_bytes") == F.col("declared_bytes"))).alias("intact")
    whole = main.select("id", "uri", F.struct("type", "refers_to", "digest", "http_status", "declared_bytes", "payload_bytes", "payload_digest", intact, "payload").alias("response"))
    return whole.join(asked, "id", "left").join(about, "id", "left")


def archive(pages: DataFrame, folder: str | None = None, payload: bool = True) -> DataFrame:
    """Writes `pages` to archives, reads them back, and returns the nested captures.

    pages: page_id, url, html; further columns are ignored.  Null and empty html is an
    empty payload; a null url is written as a placeholder.  Repeated rows are
    captures of their own, all of them responses or all revisits; as no single one is the
    original, revisits of them carry its page but no WARC-Refers-To.  Very long pages are
    written whole.  An empty table writes no record and returns no rows.  It is an error
    if fewer captures are read than were written (found without `payload`, where the archive is read once).
    """
    spark = pages.sparkSession
    folder = folder or f"{shared_dir(spark).rstrip('/')}/warc-{uuid.uuid4().hex}"
    written = write(pages, folder)
    found = read(spark, folder, payload)
    if not payload:
        found = cut(found)
        if (kept := count_of(found.where("type in ('response', 'revisit')"))) != written:
            raise ValueError(f"{written} captures were written and {kept} read")
    return captures(found)
