"""WARC archives in which repeated payloads are written once and revisited.

Headers are grouped by payload digest; of equal payloads worth it, the record
with the largest id carries the payload and the others become ``revisit`` records
that refer to it. An archive begins with a ``warcinfo`` record, holds every record as
a gzip member of its own, as WARC readers expect, and is closed once it holds so many
bytes. Archives are written and read by Spark's own file readers, so they can lie in
any store that Spark reaches.
"""

from __future__ import annotations

import gzip
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from datetime import datetime, timezone

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright.llm.shared import written

#: Payloads of fewer bytes are always written in full.
REVISIT_FROM = 1000
#: Compressed bytes that an archive holds at most, unless a single record has more.
ARCHIVE_BYTES = 16 << 20
#: Bytes that a reader unpacks at a time.
CHUNK_BYTES = 64 << 10
#: Bytes of payloads that a reader passes on at a time.
READ_BYTES = 8 << 20

# Fixed values of the WARC 1.1 format.
VERSION = "WARC/1.1"
SAME_PAYLOAD = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
CRLF = "\r\n"
GZIP = b"\x1f\x8b"

#: The last byte of most gzip members, the highest of their length, and so of most archives.
_LAST = "\0"


def resolve(pages: DataFrame, least_bytes: int = REVISIT_FROM) -> DataFrame:
    """Pages with ``digest``, ``size`` and the record each one revisits, if any.

    Columns: ``page_id``, ``url``, ``html`` (null as empty), ``digest``, ``size``,
    ``original`` (null for a response) and ``referred`` (others refer to it). Digests
    are counted per task before the shuffle, only those that repeat are joined back,
    and a hot one is one row on its side of the join.
    """
    headed = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"),
    ).withColumns({"digest": F.sha1(F.encode("html", "UTF-8")), "size": F.octet_length("html").cast("long")})
    again = (
        headed.where(F.col("size") >= least_bytes)
        .groupBy("digest")
        .agg(F.count("*").alias("times"), F.max("page_id").alias("original"))
        .where("times > 1 and original is not null")
        .select("digest", "original")
    )
    # Once written its size is known: a small table is sent to the tasks, and payloads stay put.
    joined = headed.join(written(again, "repeated").table, "digest", "left")
    revisits = ~F.col("original").eqNullSafe(F.col("page_id"))
    return joined.select(
        "page_id",
        "url",
        "html",
        "digest",
        "size",
        F.when(revisits, F.col("original")).alias("original"),
        F.col("original").eqNullSafe(F.col("page_id")).alias("referred"),
    )


def _header_value(value: Column) -> Column:
    """One line of visible text: white space and control characters are percent-escaped."""
    escaped = F.regexp_replace(F.coalesce(value, F.lit("")), "%(?![0-9A-Fa-f]{2})", "%25")
    for character in (" ", "\t", "\r", "\n"):
        escaped = F.replace(escaped, F.lit(character), F.lit(f"%{ord(character):02X}"))
    return F.regexp_replace(escaped, "[\\x00-\\x1F\\x7F]", "")


def _named(page_id: Column, digest: Column) -> Column:
    """The record id of a response that others refer to, known by its page and payload."""
    made = F.md5(F.concat_ws("/", page_id.cast("string"), digest).cast("binary"))
    parts = F.regexp_replace(made, "^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5")
    return F.concat(F.lit("<urn:uuid:"), parts, F.lit(">"))


def records(resolved: DataFrame, date: Column | None = None) -> DataFrame:
    """One row ``record`` per page: headers made anew, a blank line, the block, two line ends.

    The block of a response is an HTTP response with the whole payload, that of a
    revisit its HTTP header alone. Ids are random but for the responses that others
    refer to, so repeated rows and pages without an id have records of their own name;
    only repeated rows of a page that others refer to share one. The page's own id, and
    that of the page referred to, stand in fields of their own.
    """
    date = F.current_timestamp() if date is None else date
    stamp = F.date_format(date, "yyyy-MM-dd'T'HH:mm:ss'Z'")
    http = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
        F.col("size").cast("string"),
        F.lit(CRLF * 2),
    )
    revisit = F.col("original").isNotNull()
    length = F.octet_length(http) + F.when(revisit, F.lit(0)).otherwise(F.col("size"))
    own = F.concat(F.lit("<urn:uuid:"), F.expr("uuid()"), F.lit(">"))
    head = F.concat_ws(
        CRLF,
        F.lit(VERSION),
        F.concat(F.lit("WARC-Type: "), F.when(revisit, F.lit("revisit")).otherwise(F.lit("response"))),
        F.concat(F.lit("WARC-Record-ID: "), F.when(F.col("referred"), _named(F.col("page_id"), F.col("digest"))).otherwise(own)),
        F.concat(F.lit("WARC-Target-URI: "), _header_value(F.col("url"))),
        F.concat(F.lit("WARC-Date: "), stamp),
        F.concat(F.lit("WARC-Payload-Digest: sha1:"), F.col("digest")),
        F.when(revisit, F.lit(f"WARC-Profile: {SAME_PAYLOAD}")),
        F.when(revisit, F.concat(F.lit("WARC-Refers-To: "), _named(F.col("original"), F.col("digest")))),
        F.concat(F.lit("Page-ID: "), F.col("page_id").cast("string")),
        F.when(revisit, F.concat(F.lit("Refers-To-Page-ID: "), F.col("original").cast("string"))),
        F.lit("Content-Type: application/http; msgtype=response"),
        F.concat(F.lit("Content-Length: "), length.cast("string")),
    )
    body = F.when(revisit, F.lit("")).otherwise(F.col("html"))
    return resolved.select(F.concat(head, F.lit(CRLF * 2), http, body, F.lit(CRLF * 2)).alias("record"))


def _member(record: bytes) -> bytes:
    return gzip.compress(record, 6, mtime=0)


def _opening() -> bytes:
    """The record that an archive begins with."""
    block = f"format: {VERSION}{CRLF}".encode()
    now = datetime.now(timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")
    head = [VERSION, "WARC-Type: warcinfo", f"WARC-Record-ID: <urn:uuid:{uuid.uuid4()}>", f"WARC-Date: {now}"]
    head += ["Content-Type: application/warc-fields", f"Content-Length: {len(block)}"]
    return CRLF.join(head).encode() + _HEADER_END + block + _HEADER_END


def _archives(archive_bytes: int):
    """The function that packs a task's records into archives, one row each, without their last byte."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out() -> pa.RecordBatch:
            if members[-1][-1:] != _LAST.encode():
                members.append(gzip.compress(b"", mtime=0))  # which ends in it
            return pa.RecordBatch.from_arrays([pa.array([b"".join(members)[:-1]], pa.binary())], names=["archive"])

        members: list[bytes] = []
        held = 0
        for batch in batches:
            for record in batch.column(0).cast(pa.binary()):
                member = _member(record.as_py())
                if held and held + len(member) > archive_bytes:
                    yield out()
                    members, held = [], 0
                members = members or [_member(_opening())]
                members.append(member)
                held += len(member)
        if members:
            yield out()

    return pack


def write_archives(
    pages: DataFrame,
    path: str,
    least_bytes: int = REVISIT_FROM,
    archive_bytes: int = ARCHIVE_BYTES,
    date: Column | None = None,
) -> None:
    """Write every page as one record into archives below ``path``.

    Pages are written where they are read, without a shuffle. A task closes an archive
    before it would hold more than ``archive_bytes`` of compressed records; a record is
    never split, so one huge page makes one huge archive. A null or empty
    page is a record without payload, an empty table gives no record, and of equal
    payloads under the largest id each repeated row is a response of its own. Texts are
    whole, however long; other columns are not read, whatever they are called.

    Spark's text writer puts a separator behind every row; here that is the archive's
    last byte, which a row goes without.
    """
    packed = records(resolve(pages, least_bytes), date).mapInArrow(_archives(archive_bytes), "archive binary")
    (
        packed.select(F.col("archive").cast("string"))
        .write.option("lineSep", _LAST)
        .option("maxRecordsPerFile", 1)
        .text(path)
    )


_HEADER_END = b"\r\n\r\n"
_FIELD = re.compile(rb"([^:\r\n]+):[ \t]*([^\r\n]*)")


def parse(data: bytes) -> Iterator[tuple[dict[bytes, bytes], int, int]]:
    """Header fields (names in lower case) and the span of the block of every record."""
    at, view = 0, memoryview(data)
    while at < len(data):
        stop = data.find(_HEADER_END, at)
        if stop < 0 or not data.startswith(b"WARC/", at):
            raise ValueError(f"no WARC record at byte {at}")
        fields = {k.lower(): v for k, v in _FIELD.findall(view[at:stop])}
        start = stop + len(_HEADER_END)
        end = start + int(fields[b"content-length"])
        if data[end : end + 4] != _HEADER_END:
            raise ValueError(f"the record at byte {at} does not end where it says")
        yield fields, start, end
        at = end + 4


def _members(content: bytes) -> Iterator[bytes]:
    """The gzip members of an archive, unpacked one at a time; an archive that is not packed as it is."""
    at, view = 0, memoryview(content)
    while at < len(content):
        if content[at : at + 2] != GZIP:
            yield content[at:]
            return
        unpack, pieces = zlib.decompressobj(31), []
        while not unpack.eof:
            if at >= len(content):
                raise ValueError("the archive ends inside a record")
            pieces.append(unpack.decompress(view[at : at + CHUNK_BYTES]))
            at = min(at + CHUNK_BYTES, len(content)) - len(unpack.unused_data)
        yield b"".join(pieces)


def _records(content: bytes) -> Iterator[tuple[str | None, str, str, str, str | None, bytes | None]]:
    """Page, type, url, digest, page referred to, and payload (none in a revisit) of each page's record."""
    for data in _members(content):
        for fields, start, end in parse(data):
            kind = fields[b"warc-type"].decode()
            if kind not in ("response", "revisit"):
                continue
            at = data.index(_HEADER_END, start, end) + len(_HEADER_END)
            yield (
                fields.get(b"page-id", b"").decode() or None,
                kind,
                fields[b"warc-target-uri"].decode(),
                fields[b"warc-payload-digest"].decode().removeprefix("sha1:"),
                fields.get(b"refers-to-page-id", b"").decode() or None,
                None if kind == "revisit" else data[at:end],
            )


def _batch(rows: list[tuple], names: list[str], kinds: list[pa.DataType]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [[] for _ in names]
    return pa.RecordBatch.from_arrays(
        [pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)], names=names
    )


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["page", "record_type", "url", "digest", "refers_to", "html"]
    for batch in batches:
        for content in batch.column(0):
            rows, held = [], 0
            for *head, payload in _records(content.as_py()):
                rows.append((*head, None if payload is None else payload.decode()))
                held += len(payload or b"")
                if held > READ_BYTES:
                    yield _batch(rows, names, [pa.string()] * 6)
                    rows, held = [], 0
            yield _batch(rows, names, [pa.string()] * 6)


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["page", "record_type", "refers_to", "payload_bytes", "payload_digest"]
    kinds = [pa.string(), pa.string(), pa.string(), pa.int64(), pa.string()]
    for batch in batches:
        for content in batch.column(0):
            rows = [
                (name, kind, refers_to, *((None, None) if p is None else (len(p), hashlib.sha1(p).hexdigest())))
                for name, kind, _, _, refers_to, p in _records(content.as_py())
            ]
            yield _batch(rows, names, kinds)


def _files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").load(path).select("content")


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """Records of the archives: ``page_id``, ``record_type``, ``url``, ``digest``,
    ``refers_to`` and ``html`` (null for a revisit)."""
    found = _files(spark, path).mapInArrow(
        _read,
        "page string, record_type string, url string, digest string, refers_to string, html string",
    )
    return found.select(
        F.expr("try_cast(page as bigint)").alias("page_id"),
        "record_type",
        "url",
        "digest",
        F.expr("try_cast(refers_to as bigint)").alias("refers_to"),
        "html",
    )


def resolved_records(spark: SparkSession, path: str) -> DataFrame:
    """Every archived page with its payload's size and digest, taken from the payload itself.

    A response is measured and digested as read; a revisit takes both from the
    response it refers to, and has nulls if that is missing. Repeated rows of a
    page give repeated records; a page without an id has a null ``page_id``.
    """
    read = _files(spark, path).mapInArrow(
        _measure,
        "page string, record_type string, refers_to string, payload_bytes long, payload_digest string",
    )
    read = written(
        read.select(
            F.expr("try_cast(page as bigint)").alias("page_id"),
            "record_type",
            F.expr("try_cast(refers_to as bigint)").alias("refers_to"),
            "payload_bytes",
            "payload_digest",
        ),
        "read",
    ).table
    revisits = read.where("record_type = 'revisit'").select("page_id", "record_type", "refers_to")
    responses = read.where("record_type = 'response'")
    # Repeated rows of one page share its id; any of them will do as the original.
    originals = responses.groupBy(F.col("page_id").alias("refers_to")).agg(
        F.max("payload_bytes").alias("payload_bytes"),
        F.max("payload_digest").alias("payload_digest"),
    )
    return responses.unionByName(revisits.join(originals, "refers_to", "left")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )
