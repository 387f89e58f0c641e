"""WARC archives: a writer with revisit records, and a salvage reader.

Writing is a Spark text write: a record is one text value and the two line
breaks that end a WARC record are the writer's line separator, so executors
write archives to any file system that Spark reaches, at most ``FILE_RECORDS``
records and ``FILE_BYTES`` bytes a file.  Payloads that occur more than once are found by SHA-1 and length; the
smallest page id of each keeps the payload, the others become revisit records.
Only digests are grouped, and only repeated ones are joined back, so a payload
that a third of the pages share is one row a task before it moves, and the join
is a plain equi join that Spark may broadcast by size or split where skewed.

Reading parses every file in one pass.  A record must pass its checks: version
line, header, length, end of record, and digest of the payload.  Where one
fails, the reader searches for the next version line or gzip member that
passes them all, goes on from there, and logs the bytes between as a
quarantined gap (file, start, end, reason).  Compressed archives are read member
by member; the same search runs over the text of a member, as far as it can be
decompressed, so a bad record or a broken member of many records costs only what
it damages.  A gap inside a member has the member's place, and its own in the
reason.  A file is one row of Spark's binary source, so its size bounds the
memory of a task: that of FILE_BYTES, or of one larger record.

Defined cases: null html is an empty payload, which dedups like any other; a
null page id stays null and never is the smallest one, so it is a revisit only
where another page has an id; rows with the smallest id of their payload are
all responses, repeated rows included; a null or broken url is written with its
control characters and blanks escaped; extra columns are not read.
"""

from __future__ import annotations

import base64
import hashlib
import os
import re
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import unquote_plus

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import checkpoint_dir
from .common import bounded_batches, materialize

#: Records a file at most, and bytes: larger records are written fewer a file.
FILE_RECORDS = 500
FILE_BYTES = 1 << 27
#: Smallest payload, in bytes, that may become a revisit.
REVISIT_FROM = 0
END = "\r\n\r\n"
HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
DATE = "1970-01-01T00:00:00Z"
_BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"


def base32_of_hex(digest: Column) -> Column:
    """Base32 of a SHA-1 in hex: four groups of 40 bits, eight letters each."""
    letters = []
    for group in range(4):
        bits = F.conv(F.substring(digest, 10 * group + 1, 10), 16, 10).cast("long")
        letters += [F.substring(F.lit(_BASE32), F.shiftright(bits, 35 - 5 * k).bitwiseAND(31).cast("int") + 1, F.lit(1))
                    for k in range(8)]
    return F.concat(*letters)


def with_revisits(pages: DataFrame, revisit_from: int = REVISIT_FROM) -> DataFrame:
    """page_id, url, html, payload_bytes, sha1, and refers_to for revisits."""
    html = F.coalesce("html", F.lit(""))
    sized = pages.select("page_id", "url", html.alias("html"), F.octet_length(html).cast("long").alias("payload_bytes"),
                         F.sha1(html).alias("sha1"))
    repeated = (sized.groupBy("sha1", "payload_bytes").agg(F.min("page_id").alias("first_id"), F.count("*").alias("n"))
                .filter(f"n > 1 and payload_bytes >= {int(revisit_from)} and first_id is not null").drop("n"))
    repeated = materialize(repeated, "warc-repeated")
    joined = sized.join(repeated, ["sha1", "payload_bytes"], "left")
    return joined.withColumn("refers_to", F.when(~F.col("first_id").eqNullSafe(F.col("page_id")), F.col("first_id"))).drop("first_id")


def record_text(rows: DataFrame) -> Column:
    """A record without the line breaks that end it."""
    def urn(c: str) -> Column:
        """The id, escaped, so that ids of any content come back; null has a name of its own."""
        return F.concat(F.coalesce(F.concat(F.lit("<urn:page:"), F.url_encode(F.col(c).cast("string"))), F.lit("<urn:null")), F.lit(">\r\n"))

    url = F.regexp_replace(F.coalesce("url", F.lit("urn:none")), r"[\x00-\x20\x7F]", "%20")
    digest = F.concat(F.lit("WARC-Payload-Digest: sha1:"), base32_of_hex(F.col("sha1")), F.lit("\r\n"))
    size = F.col("payload_bytes")
    revisit = F.col("refers_to").isNotNull()
    length = F.when(revisit, F.lit(0)).otherwise(size + len(HTTP))
    return F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: "), F.when(revisit, F.lit("revisit")).otherwise(F.lit("response")),
        F.lit("\r\nWARC-Record-ID: "), urn("page_id"), F.lit("WARC-Target-URI: "), url,
        F.lit(f"\r\nWARC-Date: {DATE}\r\n"), digest,
        F.when(revisit, F.concat(
            F.lit("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest\r\nWARC-Refers-To: "),
            urn("refers_to"), F.lit("X-Payload-Length: "), size.cast("string"), F.lit("\r\n"))).otherwise(F.lit("")),
        F.lit("Content-Type: application/http; msgtype=response\r\nContent-Length: "), length.cast("string"), F.lit(END),
        F.when(revisit, F.lit("")).otherwise(F.concat(F.lit(HTTP), F.col("html"))))


def write_archives(pages: DataFrame, path: str, revisit_from: int = REVISIT_FROM, file_records: int = FILE_RECORDS,
                   file_bytes: int = FILE_BYTES) -> None:
    """Archives of at most ``file_records`` records and ``file_bytes`` bytes (a larger
    record has a file of its own).  Records are written by classes of size, each
    twice the one before: usually all are in the first."""
    rows = with_revisits(pages, revisit_from)
    rows = rows.select(record_text(rows).alias("value"))
    first = max(1, file_bytes // file_records)
    size = F.octet_length("value") + len(END)
    size_class = F.greatest(F.lit(0), F.ceil(F.log2(size / F.lit(first)))).cast("int")
    # no record is larger than its page, an escaped url and a header
    page = F.octet_length(F.coalesce("html", F.lit(""))) + 3 * F.octet_length(F.coalesce("url", F.lit(""))) + 8 * F.octet_length(
        F.coalesce(F.col("page_id").cast("string"), F.lit(""))) + 1000
    largest = pages.agg(F.max(page.cast("long"))).first()[0] or 0
    classes = 0
    while first << classes < largest:
        classes += 1
    for k in range(classes + 1):
        some = rows if not classes else rows.filter(size_class == k)
        (some.select("value").write.mode("append").option("lineSep", END)
         .option("maxRecordsPerFile", max(1, file_bytes // (first << k))).text(path))


_START = re.compile(rb"WARC/1\.[01]\r\n|\x1f\x8b\x08")
_VERSION = re.compile(rb"WARC/1\.[01]\r\n")
_END = END.encode()


class Broken(ValueError):
    """A record that fails a check."""


def _record(data: bytes, at: int) -> tuple[dict, int]:
    """The record at a version line, and the place after its end."""
    if not _VERSION.match(data, at):
        raise Broken("no version line")
    fields: dict[str, str] = {}
    # a header of any length; the next version line has no name, so no search runs far past it
    line_at = data.index(b"\r\n", at) + 2
    while True:
        line_end = data.find(b"\r\n", line_at)
        if line_end < 0:
            raise Broken("header without end")
        if line_end == line_at:
            break
        name, colon, value = data[line_at:line_end].partition(b":")
        if not colon:
            raise Broken("header line without a name")
        fields[name.strip().lower().decode("latin-1")] = value.strip().decode("utf-8", "replace")
        line_at = line_end + 2
    if "warc-type" not in fields or "warc-record-id" not in fields:
        raise Broken("no record type or id")
    length = fields.get("content-length", "")
    if not (length.isascii() and length.isdigit() and len(length) < 16):
        raise Broken("no content length")
    start = line_end + 2
    end = start + int(length)
    if data[end:end + len(_END)] != _END:
        raise Broken("no end of record at the content length")
    block = data[start:end]
    kind = fields.get("warc-type", "")
    payload = block.partition(_END)[2] if kind == "response" and block.startswith(b"HTTP/") else block
    digest = fields.get("warc-payload-digest", "").removeprefix("sha1:")
    if kind == "response" and digest and digest != sha1_base32(payload):
        raise Broken("payload digest differs")
    return {"fields": fields, "type": kind, "payload": payload, "digest": digest or sha1_base32(payload)}, end + len(_END)


def sha1_base32(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _inflate(data: bytes, at: int) -> tuple[bytes, int, str | None]:
    """The text of the gzip member that starts here as far as it goes, the place
    where it ends or breaks off, and what is wrong with it."""
    unzip, parts, place = zlib.decompressobj(31), [], at
    while not unzip.eof and place < len(data):
        before, chunk = unzip.copy(), data[place:place + (1 << 16)]
        try:
            parts.append(unzip.decompress(chunk))
        except zlib.error:  # the call's text is lost with it: byte by byte up to the break
            for k in range(len(chunk)):
                try:
                    parts.append(before.decompress(chunk[k:k + 1]))
                except zlib.error as e:
                    return b"".join(parts), place + k, f"gzip member: {e}"
        place += len(chunk)
    return b"".join(parts), place - len(unzip.unused_data), None if unzip.eof else "gzip member without end"


def _member(data: bytes, at: int) -> tuple[list[tuple[str, object]], int, str | None, bytes]:
    """What was salvaged of the gzip member that starts here: records, and the
    reasons of gaps; the place where it ends or breaks off, what is wrong with
    it, and its text."""
    text, end, wrong = _inflate(data, at)
    found = [(what, x if what == "record" else f"{x} (bytes {a} to {b} of the member that starts at {at})")
             for what, a, b, x in _salvage(text, _VERSION)]
    # the end and checksum of a member of one record are checks of that record
    if (wrong and [what for what, _ in found] == ["record"]) or (
            not any(what == "record" for what, _ in found) and (found or wrong)):
        raise Broken(wrong or str(found[0][1]))
    return found, end, wrong, text


def salvage(data: bytes) -> Iterator[tuple[str, int, int, object]]:
    """("record", start, end, record) and ("gap", start, end, reason), which
    together cover every byte of the archive in order."""
    return _salvage(data, _START)


def _salvage(data: bytes, starts: re.Pattern) -> Iterator[tuple[str, int, int, object]]:
    """``starts``: what a record or member begins with."""

    def at(place: int) -> tuple[list[tuple[str, object]], int, str | None, bytes]:
        if starts is _START and data.startswith(b"\x1f\x8b\x08", place):
            return _member(data, place)
        record, end = _record(data, place)
        return [("record", record)], end, None, b""

    def after(place: int, upto: int, text: bytes) -> tuple[int, tuple | None]:
        """The next start that can be read. A record that lies plain in the bytes of a
        broken member (up to ``upto``) was found in its text."""
        for hit in starts.finditer(data, place):
            try:
                got = at(hit.start())
            except Broken:
                continue
            if hit.start() < upto and not got[3] and data[hit.start():got[1]] in text:
                continue
            return hit.start(), got
        return len(data), None

    place, got = 0, None
    while place < len(data):
        if got is None:
            try:
                got = at(place)
            except Broken as e:
                gap = place
                place, got = after(gap + 1, 0, b"")
                yield "gap", gap, place, str(e)
                continue
        found, end, wrong, text = got
        if wrong:  # where a broken member ends isn't known: the next start may lie before the break
            end, got = after(place + 1, end, text)
        else:
            got = None
        for what, x in found:
            yield what, place, end, x
        if wrong:
            yield "gap", place, end, f"{wrong} ({len(text)} bytes of text before it)"
        place = end


PARSED = T.StructType([
    T.StructField("file", T.StringType()), T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()),
    T.StructField("end", T.LongType()), T.StructField("reason", T.StringType()), T.StructField("record_type", T.StringType()),
    T.StructField("record_id", T.StringType()), T.StructField("url", T.StringType()), T.StructField("payload_bytes", T.LongType()),
    T.StructField("payload_digest", T.StringType()), T.StructField("refers_to", T.StringType()),
    T.StructField("payload", T.BinaryType())])


def _id(urn: str | None) -> str | None:
    name = (urn or "").removesuffix(">")
    return unquote_plus(name.removeprefix("<urn:page:")) if name.startswith("<urn:page:") else None


def read_archives(spark: SparkSession, path: str, payloads: bool = False) -> DataFrame:
    """Records (kind "record") and quarantined gaps (kind "gap") of all archives
    under a path; ``payloads`` also returns the payload bytes of responses."""
    bounded_batches(spark)

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.schema([(f.name, pa.int64() if f.dataType == T.LongType() else pa.binary()
                           if f.dataType == T.BinaryType() else pa.string()) for f in PARSED])
        for batch in batches:
            for file, data in zip(batch.column(0).to_pylist(), batch.column(1)):
                rows, held = [], 0
                for what, start, end, found in salvage(data.as_py()):
                    row = {"file": file, "kind": what, "start": start, "end": end}
                    if what == "gap":
                        row["reason"] = found
                    else:
                        f = found["fields"]
                        size = f.get("x-payload-length", "") if found["type"] == "revisit" else ""
                        row |= {"record_type": found["type"], "record_id": _id(f.get("warc-record-id")),
                                "url": f.get("warc-target-uri"), "payload_digest": found["digest"],
                                "payload_bytes": int(size) if size.isdigit() else len(found["payload"]),
                                "refers_to": _id(f.get("warc-refers-to")),
                                "payload": found["payload"] if payloads and found["type"] == "response" else None}
                        held += len(row["payload"] or b"")
                    rows.append(row)
                    if len(rows) >= 1000 or held >= 1 << 22:
                        yield pa.RecordBatch.from_pylist(rows, kind)
                        rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, kind)

    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return files.select("path", "content").mapInArrow(parse, PARSED)


def round_trip(pages: DataFrame, revisit_from: int = REVISIT_FROM) -> DataFrame:
    """Write the pages as archives and read them back: one row per page with
    page_id, payload_bytes, payload_digest, record_type, refers_to, file, start, end.
    A gap in these archives would be a missing page, so it is an error."""
    spark = pages.sparkSession
    path = os.path.join(checkpoint_dir(spark), "starloom", f"warc-{uuid.uuid4().hex}")
    write_archives(pages, path, revisit_from)
    kind = pages.schema["page_id"].dataType
    gap = F.raise_error(F.concat_ws(" ", F.lit("gap in an archive just written:"), "file", "start", "end", "reason"))
    return read_archives(spark, path).filter(F.when(F.col("kind") == "record", F.lit(True)).otherwise(gap)).select(
        F.col("record_id").cast(kind).alias("page_id"), "payload_bytes", "payload_digest", "record_type",
        F.col("refers_to").cast(kind).alias("refers_to"), "file", "start", "end")


_LETTERS = " || ".join(
    f"substr('{_BASE32}', ((('0x' || substr(h, {10 * g + 1}, 10))::BIGINT >> {35 - 5 * k}) & 31)::INT + 1, 1)"
    for g in range(4) for k in range(8))

#: The round trip's rows as DuckDB SQL over ``pages``.
SQL = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS h FROM pages),
f AS (SELECT *, min(page_id) OVER (PARTITION BY html) AS first_id FROM p)
SELECT page_id, strlen(html)::BIGINT AS payload_bytes, {_LETTERS} AS payload_digest,
       CASE WHEN first_id IS NULL OR first_id IS NOT DISTINCT FROM page_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN first_id IS DISTINCT FROM page_id THEN first_id END AS refers_to
FROM f
"""
