"""WARC archives: writing, reading, and resolving copies into revisit records.

Archives are written by Spark's text writer with the record separator as line end, so each file
is a run of whole WARC/1.1 records, committed task by task on any file system, gzip-compressed.
They are read back as binary files, unpacked piece by piece and cut by ``Content-Length``, as
payloads may hold anything; a reader holds the packed file and one record.

Archives of other writers are read, too: any record id, any record type, payloads of any bytes, a file of one
gzip member or of one per record. What is no HTTP message (``warcinfo``, ``metadata``,
``resource``) has its whole block as payload. Payload digests and lengths are taken from the
payload itself, whatever a header says; only a revisit record, which has none, is believed. Header
lines the operator knows nothing of are kept, block digests are not, as blocks change.

Copies are resolved on headers only: they are grouped by payload digest and length (map-side
combining), the record with the largest id of a group keeps its payload (own ids by number and
above all others, which go by their text), and the others are
joined to it as revisit records. Only digests with copies take part in that join, from a written
table, so Spark can split a payload that a third of all pages share. The payloads travel once, when
the deduplicated archives are written, with headers made anew. All other records pass through.

A null payload is an empty one; a null address gives no ``WARC-Target-URI``. Line ends in an
address are percent-encoded. Rows of equal id and payload are one record written several times
and stay alike. Rows without an id are not archived, as nothing could refer to them; records
without one are no copies. An archive that is cut short is an error. An empty table gives archives without records.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kessan.llm.columns import narrow
from kessan.session import scratch_path, written

#: Records of an archive file at most.
PER_FILE = 1024

#: Packed bytes unpacked at a time; payload bytes after which a batch of records is handed on.
_PIECE, _BATCH_BYTES = 1 << 16, 8 << 20
_END = "\r\n"
_RECORD_ID = "urn:record:"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: Of each record: its id, as number where this operator made it; of a revisit, the record meant;
#: the HTTP head, with its empty line; header lines not named here; the payload.
SCHEMA = (
    "id long, record_id string, uri string, date string, type string, digest string, payload_bytes long, "
    "refers_to long, refers_to_record string, refers_to_uri string, profile string, content_type string, "
    "http binary, more string, content binary"
)
_KNOWN = {
    "warc-type", "warc-record-id", "warc-date", "warc-target-uri", "warc-payload-digest", "warc-block-digest", "warc-profile",
    "warc-refers-to", "warc-refers-to-target-uri", "content-type", "content-length",
}


def base32_sha1(payload: Column) -> Column:
    """SHA-1 of a text's UTF-8 bytes in upper-case base 32: five hex digits are four of its digits."""
    digits = F.sha1(F.encode(payload, "UTF-8"))
    parts = [F.lpad(F.conv(F.substring(digits, 1 + 5 * i, 5), 16, 32), 4, "0") for i in range(8)]
    return F.translate(F.concat(*parts), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def _field(name: str, value: Column) -> Column:
    """A header line, or nothing where the value is null."""
    return F.coalesce(F.concat(F.lit(f"{name}: "), value.cast("string"), F.lit(_END)), F.lit(""))


def _encoded(line: str, value: Column) -> Column:
    """An address as a header line, with line ends percent-encoded."""
    return _field(line, F.regexp_replace(F.regexp_replace(value, "\r", "%0D"), "\n", "%0A"))


def record_texts(records: DataFrame) -> DataFrame:
    """``value``: the text of each record, up to the separator that ends it. ``records``: ``SCHEMA``."""
    revisit, empty = F.col("type") == "revisit", F.lit(b"")
    block = F.concat(F.coalesce("http", empty), F.when(revisit, empty).otherwise(F.coalesce("content", empty)))
    header = F.concat(
        F.lit(f"WARC/1.1{_END}"),
        _field("WARC-Type", F.col("type")),
        _field("WARC-Record-ID", F.concat(F.lit("<"), F.col("record_id"), F.lit(">"))),
        _field("WARC-Date", F.col("date")),
        _encoded("WARC-Target-URI", F.col("uri")),
        _field("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
        _field("WARC-Profile", F.when(revisit, F.coalesce("profile", F.lit(PROFILE)))),
        _field("WARC-Refers-To", F.concat(F.lit("<"), F.col("refers_to_record"), F.lit(">"))),
        _encoded("WARC-Refers-To-Target-URI", F.col("refers_to_uri")),
        F.coalesce("more", F.lit("")),
        _field("Content-Type", F.col("content_type")),
        _field("Content-Length", F.octet_length("block")),
        F.lit(_END),
    )
    text = F.concat(F.encode(header, "UTF-8"), F.col("block")).cast("string")
    return records.withColumn("block", block).select(text.alias("value"))


def write_archives(records: DataFrame, path: str) -> None:
    """One folder of gzip-compressed archives."""
    record_texts(records).write.option("lineSep", _END + _END).option("compression", "gzip").option(
        "maxRecordsPerFile", PER_FILE
    ).text(path)


def responses(pages: DataFrame, date: str, key: str = "page_id", uri: str = "url", payload: str = "html") -> DataFrame:
    """Pages as response records (``SCHEMA``), all of one date (ISO 8601)."""
    named = narrow(pages, id=key, uri=uri, payload=payload).filter("id IS NOT NULL")
    text = F.coalesce("payload", F.lit(""))
    size = F.octet_length(text).cast("long")
    http = F.concat(
        F.lit(f"HTTP/1.1 200 OK{_END}Content-Type: text/html; charset=utf-8{_END}"), _field("Content-Length", size), F.lit(_END)
    )
    nothing = F.lit(None).cast("string")
    return named.select(
        F.col("id").cast("long").alias("id"), F.concat(F.lit(_RECORD_ID), F.col("id").cast("long")).alias("record_id"),
        "uri", F.lit(date).alias("date"), F.lit("response").alias("type"),
        base32_sha1(text).alias("digest"), size.alias("payload_bytes"), F.lit(None).cast("long").alias("refers_to"),
        *(nothing.alias(name) for name in ("refers_to_record", "refers_to_uri", "profile")),
        F.lit("application/http; msgtype=response").alias("content_type"), F.encode(http, "UTF-8").alias("http"),
        nothing.alias("more"), F.encode(text, "UTF-8").alias("content"),
    )


class _Unpacked:
    """The bytes of an archive in order, unpacked as they are asked for."""

    def __init__(self, data: bytes):
        self.pieces, self.ready = self._pieces(memoryview(data)), bytearray()

    @staticmethod
    def _pieces(data: memoryview) -> Iterator[bytes | memoryview]:
        if data[:2] != b"\x1f\x8b":
            yield data
            return
        at = 0
        while at < len(data):
            member = zlib.decompressobj(31)
            while not member.eof:
                if at >= len(data):
                    raise ValueError("an archive is cut short")
                yield member.decompress(data[at : at + _PIECE])
                at = min(at + _PIECE, len(data))
            at -= len(member.unused_data)

    def _more(self) -> bool:
        piece = next(self.pieces, None)
        self.ready += piece or b""
        return piece is not None

    def ended(self) -> bool:
        while not self.ready:
            if not self._more():
                return True
        return False

    def take(self, n: int) -> bytes:
        while len(self.ready) < n:
            if not self._more():
                raise ValueError("an archive is cut short")
        out = bytes(memoryview(self.ready)[:n])
        del self.ready[:n]
        return out

    def head(self) -> bytes:
        """Up to and without the next empty line, which is skipped."""
        seen = 0
        while (end := self.ready.find(b"\r\n\r\n", seen)) < 0:
            seen = max(0, len(self.ready) - 3)
            if not self._more():
                raise ValueError("an archive is cut short")
        return self.take(end + 4)[:end]


def _fields(head: bytes) -> dict[str, str]:
    """The header lines after the first, by name in lower case."""
    lines = (line.partition(":") for line in head.decode("utf-8", "replace").split(_END)[1:])
    return {name.strip().lower(): value.strip() for name, _, value in lines if name.strip()}


def _records(data: bytes) -> Iterator[tuple[bytes, bytes | None, bytes]]:
    """``(WARC head, HTTP head with its empty line or None, payload)`` of each record."""
    archive = _Unpacked(data)
    while not archive.ended():
        head = archive.head()
        warc = _fields(head)
        block = archive.take(int(warc["content-length"]))
        if archive.take(4) != b"\r\n\r\n":
            raise ValueError("a record does not end where its header says")
        kind, http = warc.get("content-type", "").lower(), None
        if kind.startswith("application/http") or not kind and warc.get("warc-type") in ("response", "revisit", "request"):
            end = block.find(b"\r\n\r\n")
            end = len(block) if end < 0 else end + 4
            http, block = block[:end], block[end:]
        yield head, http, block


def parse_records(data: bytes) -> Iterator[tuple[dict[str, str], dict[str, str], bytes]]:
    """``(WARC fields, HTTP fields, payload)`` of each record of an archive; names in lower case."""
    for head, http, payload in _records(data):
        yield _fields(head), _fields(http or b""), payload


def _number(record_id: str | None) -> int | None:
    """The number in an id this operator made."""
    text = (record_id or "").removeprefix(_RECORD_ID)
    if text == record_id or not text.removeprefix("-").isdecimal():
        return None
    return int(text) if -(1 << 63) <= int(text) < 1 << 63 else None


def _row(head: bytes, http: bytes | None, payload: bytes, payloads: bool) -> tuple:
    """A record as a row of ``SCHEMA``."""
    warc = _fields(head)
    of = lambda name: warc[name].strip("<>") if name in warc else None
    if warc.get("warc-type") == "revisit":
        digest, stated = warc.get("warc-payload-digest", "").removeprefix("sha1:"), _fields(http or b"").get("content-length", "")
        size = int(stated) if stated.isdecimal() else None
    else:
        digest, size = base64.b32encode(hashlib.sha1(payload).digest()).decode(), len(payload)
    lines = head.decode("utf-8", "replace").split(_END)[1:]
    more = "".join(line + _END for line in lines if line.partition(":")[0].strip().lower() not in _KNOWN)
    return (
        _number(of("warc-record-id")), of("warc-record-id"), warc.get("warc-target-uri"), warc.get("warc-date"),
        warc.get("warc-type"), digest, size, _number(of("warc-refers-to")), of("warc-refers-to"),
        warc.get("warc-refers-to-target-uri"), warc.get("warc-profile"), warc.get("content-type"),
        http if payloads else None, more or None, payload if payloads else None,
    )


def read_archives(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """The records of all archives in a folder: ``SCHEMA``, and the payload of a response as text
    where it is UTF-8 (``payload``). Without ``payloads`` only headers leave the reader."""
    text, number, raw = pa.string(), pa.int64(), pa.binary()
    kinds = [number, *[text] * 5, number, number, *[text] * 4, raw, text, raw]
    names = [part.split()[0] for part in SCHEMA.split(", ")]

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        columns = zip(*rows, strict=True)
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                rows, size = [], 0
                for record in _records(content.as_py()):
                    rows.append(_row(*record, payloads))
                    size += len(record[2]) if payloads else 0
                    if len(rows) == 512 or size > _BATCH_BYTES:
                        yield batch_of(rows)
                        rows, size = [], 0
                if rows:
                    yield batch_of(rows)

    files = spark.read.format("binaryFile").load(path).filter(F.col("length") > 0)
    found = files.select("content").mapInArrow(work, SCHEMA)
    return found.withColumn("payload", F.when(F.col("type") == "response", F.try_validate_utf8(F.col("content").cast("string"))))


def resolve_revisits(spark: SparkSession, source: str, target: str, least_bytes: int = 0) -> None:
    """Read the archives of ``source`` and write them to ``target`` without repeated payloads.

    Of response records with equal payloads of ``least_bytes`` or more, the one with the largest
    id stays a response; the others become revisits of it. Smaller payloads stay as they are.
    """
    wanted = "id", "record_id", "uri", "type", "digest", "payload_bytes"
    headers = written(read_archives(spark, source, payloads=False).select(*wanted), "warc-headers")
    candidates = headers.filter((F.col("type") == "response") & (F.col("payload_bytes") >= least_bytes))
    groups = candidates.groupBy("digest", "payload_bytes").agg(
        F.count(F.lit(1)).alias("n"), F.max(F.struct("id", "record_id", "uri")).alias("original")
    )
    copied = written(groups.filter("n > 1").select("digest", "payload_bytes", "original"), "warc-originals")
    found = candidates.join(copied, ["digest", "payload_bytes"]).select("record_id", "digest", "original")
    decided = written(
        found.filter(F.col("record_id") != F.col("original.record_id")).distinct().select(
            "record_id", "digest", F.col("original.record_id").alias("refers"), F.col("original.uri").alias("refers_uri"),
            F.lit(True).alias("copy"),
        ),
        "warc-decisions",
    )
    records = read_archives(spark, source).drop("payload").join(decided, ["record_id", "digest"], "left")
    # A digest alone does not tell a response from another record of its id.
    copy = F.col("copy").isNotNull() & (F.col("type") == "response")
    write_archives(
        records.withColumns({
            "type": F.when(copy, "revisit").otherwise(F.col("type")),
            "refers_to_record": F.when(copy, F.col("refers")).otherwise(F.col("refers_to_record")),
            "refers_to_uri": F.when(copy, F.col("refers_uri")).otherwise(F.col("refers_to_uri")),
        }),
        target,
    )


def archive_pages(
    pages: DataFrame, date: str, least_bytes: int = 0, key: str = "page_id", uri: str = "url", payload: str = "html"
) -> DataFrame:
    """Archive pages, resolve their copies, and read the headers of the deduplicated archives."""
    spark = pages.sparkSession
    source, target = scratch_path(spark, "warc"), scratch_path(spark, "warc-deduplicated")
    write_archives(responses(pages, date, key, uri, payload), source)
    resolve_revisits(spark, source, target, least_bytes)
    return read_archives(spark, target, payloads=False)
