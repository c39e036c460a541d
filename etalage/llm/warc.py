"""WARC archives with revisit resolution.

Payload digests are worked out without moving payloads; the headers (digest, id,
url) are aggregated by digest, and the original of each payload (the record with
the smallest id) is joined to the records, which are then written once: the
original as ``response``, the others as ``revisit`` records without payload, with
fresh headers that refer to it. Reading joins revisits to their responses by
record id.

Files. Every record is a gzip member of its own, as the WARC standard wants.
Spark's text writer puts the files down, so its commit protocol holds if an
executor is lost. That writer ends each value with a separator; the separator
here is the zero byte with which a gzip member of up to 16 MB ends anyway (the
high byte of its length), and a larger member is followed by an empty one.

Scale: one aggregation of headers (partial first, so a payload that a third of
the pages share is one row per task), one shuffle of payloads by digest, which
adaptive execution splits where a digest is hot. A file is read as a whole by one
task; its size is that of a shuffle partition.

Defined cases: a null html is the empty payload; a null url gives ``urn:page:<id>``;
a null id is never the original of a payload that also has a record with an id;
records that share the smallest id of a payload are all responses; an empty table
gives no files and no rows; other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

MIN_REVISIT_BYTES = 0
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_EMPTY_MEMBER = zlib.compressobj(1, zlib.DEFLATED, 31).flush()


def base32_sha1(value: Column) -> Column:
    """Bare upper-case base32 of a value's SHA-1: five hex digits are four base-32 ones."""
    digest = F.sha1(value)
    digits = F.concat(*[F.lpad(F.conv(F.substring(digest, 5 * k + 1, 5), 16, 32), 4, "0") for k in range(8)])
    return F.translate(F.upper(digits), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def record_id(page_id: Column, digest: Column) -> Column:
    """A record's urn, the same in every run."""
    h = F.md5(F.concat_ws("|", F.coalesce(page_id.cast("string"), F.lit("")), digest))
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *[F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]), F.lit(">"))


def resolve_revisits(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html",
                     min_revisit_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """Each page with payload, payload_bytes, digest, record_type, and the original's id and url."""
    payload = F.coalesce(F.col(html), F.lit(""))
    target = F.coalesce(F.regexp_replace(F.col(url), r"[\x00-\x20\x7F]", "%20"), F.concat(F.lit("urn:page:"), F.coalesce(F.col(page_id).cast("string"), F.lit(""))))
    rows = pages.select(
        F.col(page_id).cast("long").alias("page_id"), target.alias("target"), payload.alias("payload"),
        F.octet_length(payload).cast("long").alias("payload_bytes"), base32_sha1(payload).alias("digest"))
    originals = rows.where(f"payload_bytes >= {min_revisit_bytes} and page_id is not null").groupBy("digest").agg(
        F.min(F.struct("page_id", "target")).alias("original"))
    again = F.col("original").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("original.page_id"))
    return rows.join(originals, "digest", "left").withColumn("record_type", F.when(again, "revisit").otherwise("response"))


def _record(date: str) -> Column:
    """Header and block of a record, as one string."""
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
                    F.col("payload_bytes").cast("string"), F.lit("\r\n\r\n"))
    again = F.col("record_type") == "revisit"
    block = F.when(again, http).otherwise(F.concat(http, F.col("payload")))
    lines = [
        F.lit("WARC/1.1"),
        F.concat(F.lit("WARC-Type: "), F.col("record_type")),
        F.concat(F.lit("WARC-Record-ID: "), record_id(F.col("page_id"), F.col("digest"))),
        F.lit(f"WARC-Date: {date}"),
        F.concat(F.lit("WARC-Target-URI: "), F.col("target")),
        F.concat(F.lit("WARC-Payload-Digest: sha1:"), F.col("digest")),
        F.concat(F.lit("WARC-Block-Digest: sha1:"), base32_sha1(F.col("block"))),
        F.concat(F.lit("X-Page-ID: "), F.coalesce(F.col("page_id").cast("string"), F.lit(""))),
        F.when(again, F.concat_ws(
            "\r\n", F.lit(f"WARC-Profile: {PROFILE}"),
            F.concat(F.lit("WARC-Refers-To: "), record_id(F.col("original.page_id"), F.col("digest"))),
            F.concat(F.lit("WARC-Refers-To-Target-URI: "), F.col("original.target")),
            F.lit(f"WARC-Refers-To-Date: {date}"))),
        F.lit("Content-Type: application/http; msgtype=response"),
        F.concat(F.lit("Content-Length: "), F.octet_length("block").cast("string")),
    ]
    return block, F.concat(F.concat_ws("\r\n", *lines), F.lit("\r\n\r\n"), F.col("block"), F.lit("\r\n\r\n"))


def gzip_member(raw: bytes) -> bytes:
    """A gzip member without its last byte, which is zero."""
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    member = packer.compress(raw) + packer.flush()
    return member[:-1] if member[-1] == 0 else member + _EMPTY_MEMBER[:-1]


def write_archives(resolved: DataFrame, path: str, date: str = "2024-01-01T00:00:00Z") -> None:
    """Write records of :func:`resolve_revisits` as WARC files (gzip, one member a record)."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([gzip_member(x.as_buffer()) for x in b.column(0).cast(pa.binary())], pa.binary())], ["value"])

    block, record = _record(date)
    packed = resolved.withColumn("block", block).select(record.alias("value")).mapInArrow(pack, "value binary")
    packed.select(F.col("value").cast("string").alias("value")).write.option("lineSep", "\0").text(path)


def members(content: memoryview, step: int = 1 << 16) -> Iterator[bytes]:
    """The unpacked gzip members of a file, one at a time."""
    at = 0
    while at < len(content):
        unpacker, out = zlib.decompressobj(31), []
        while not unpacker.eof:
            if at >= len(content):
                raise ValueError("an archive ends inside a record")
            piece = content[at : at + step]
            out.append(unpacker.decompress(piece))
            at += len(piece)
        at -= len(unpacker.unused_data)
        if raw := b"".join(out):
            yield raw


def parse_record(raw: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields (lower-case names) and the block, by its Content-Length."""
    cut = raw.index(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in raw[:cut].decode().split("\r\n")[1:])
    fields = {k.lower(): v for k, v in fields.items()}
    return fields, raw[cut + 4 : cut + 4 + int(fields["content-length"])]


_HEAD = "record_id string, page_id long, record_type string, payload_bytes long, payload_digest string, refers_to_record string"
_READ = [("record_id", pa.string()), ("page_id", pa.int64()), ("record_type", pa.string()), ("payload_bytes", pa.int64()),
         ("payload_digest", pa.string()), ("refers_to_record", pa.string())]


def _heads(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for content in b.column(0):
            rows = []
            for raw in members(memoryview(content.as_buffer())):
                h, block = parse_record(raw)
                cut = block.index(b"\r\n\r\n")
                length = next(int(x.split(b":")[1]) for x in block[:cut].split(b"\r\n") if x.lower().startswith(b"content-length:"))
                digest = h["warc-payload-digest"].removeprefix("sha1:")
                if h["warc-type"] == "response":
                    payload = block[cut + 4 :]
                    if len(payload) != length or base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest:
                        raise ValueError(f"{h['warc-record-id']}: the payload is not what its header says")
                page = h.get("x-page-id", "")
                rows.append((h["warc-record-id"], int(page) if page else None, h["warc-type"], length, digest, h.get("warc-refers-to")))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(zip(*rows, strict=True), _READ, strict=True)], [n for n, _ in _READ])


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """Records of the archives: page_id, payload_bytes, payload_digest, record_type,
    refers_to (the id of the response that a revisit refers to)."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    heads = files.select("content").mapInArrow(_heads, _HEAD)
    originals = heads.where("record_type = 'response'").groupBy(F.col("record_id").alias("refers_to_record")).agg(
        F.min("page_id").alias("refers_to"))
    return heads.join(originals, "refers_to_record", "left").select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
