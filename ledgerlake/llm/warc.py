"""WARC archives with revisit resolution.

Records with equal payloads are written once. Headers (key, digest, length, target) are
shuffled by payload digest, the record with the smallest key of a digest becomes the
`response`, the others become `revisit` records that refer to it, all with fresh headers.
Archives are plain WARC 1.1 files that Spark's text writer commits (one file per task, one
record per row), so a lost task is simply run again. Reading parses records by their
Content-Length and joins revisits to the responses by digest to get what they stand for.

The hot digest: captures are counted by raw SHA-1 (map-side partial aggregates) and joined
by the base-32 form, so both join sides have an exchange of their own and the adaptive
skew-join rule can split a digest that a third of all records share. Payloads cross the
network once, in that join; the copies are gone after it. Reading holds one compressed
archive and one record at a time.

Defined results: a null payload is an empty one; records that share the smallest key of
their digest are all responses; a null key sorts last, and a group of null keys only is
all responses; a null target is written as `urn:none`; white space and control characters
in a target are percent-encoded; an empty table writes an empty archive.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
from collections.abc import Iterator
from typing import BinaryIO

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.llm import common

CRLF = "\r\n"
DATE = "2024-01-01T00:00:00Z"
# Values of the WARC 1.1 format.
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP_TYPE = "application/http; msgtype=response"
# An archive is read as one value: files hold about so many bytes of payload, on average.
ARCHIVE_BYTES = 32 * 1024 * 1024

_ALPHABET_OF_CONV = "0123456789ABCDEFGHIJKLMNOPQRSTUV"
_BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"


def base32_of_hex(digest):
    """Upper-case base-32 of a 40-digit hex string: 5 hex digits are 4 base-32 digits."""
    parts = [F.lpad(F.conv(F.substring(digest, 5 * i + 1, 5), 16, 32), 4, "0") for i in range(8)]
    return F.translate(F.concat(*parts), _ALPHABET_OF_CONV, _BASE32)


def records(pages: DataFrame, key: str = "page_id", target: str = "url", payload: str = "html") -> DataFrame:
    """(key, target, payload, bytes, sha1): one capture per row."""
    body = F.coalesce(F.col(payload).cast("binary"), F.lit(b""))
    return pages.select(F.col(key).alias("key"), F.col(target).cast("string").alias("target"),
                        body.alias("payload")).select(
        "*", F.octet_length("payload").cast("long").alias("bytes"), F.sha1("payload").alias("sha1"))


def originals(captures: DataFrame, least_bytes: int = 0) -> DataFrame:
    """(digest, original, original_target) of the digests that several captures share."""
    headers = captures.where(F.col("bytes") >= least_bytes).select("sha1", "key", "target")
    return headers.groupBy("sha1").agg(
        F.min(F.struct(F.col("key").isNull().alias("last"), "key", "target")).alias("first"),
        F.count("*").alias("n")).where("n > 1").select(
        base32_of_hex(F.col("sha1")).alias("digest"), F.col("first.key").alias("original"),
        F.col("first.target").alias("original_target"))


def deduplicated(captures: DataFrame, least_bytes: int = 0) -> DataFrame:
    """The captures with `digest`, `original` and `original_target` (null for a response);
    a revisit's payload is gone."""
    c = captures.withColumn("digest", base32_of_hex(F.col("sha1"))).drop("sha1")
    shared = originals(captures, least_bytes)
    fate = (F.col("bytes") >= least_bytes) & F.col("original").isNotNull() & ~F.col("key").eqNullSafe(F.col("original"))
    return c.join(shared, "digest", "left").select(
        "key", "target", "bytes", "digest", F.when(~F.coalesce(fate, F.lit(False)), F.col("payload")).alias("payload"),
        F.when(fate, F.col("original")).alias("original"),
        F.when(fate, F.col("original_target")).alias("original_target"))


def _uri(c):
    clean = F.coalesce(F.col(c), F.lit("urn:none"))
    for code in (*range(33), 127):
        clean = F.replace(clean, F.lit(chr(code)), F.lit(f"%{code:02X}"))
    return F.when(F.col(c).rlike("[\\x00-\\x20\\x7F]"), clean).otherwise(F.coalesce(F.col(c), F.lit("urn:none")))


def _record_id(key, target, digest):
    """A name-based id: the same record has the same id in every rerun."""
    h = F.md5(F.concat_ws("|", F.coalesce(key.cast("string"), F.lit("-")), digest))
    return F.concat(F.lit("<urn:uuid:"), F.regexp_replace(h, "^(.{8})(.{4})(.{4})(.{4})", "$1-$2-$3-$4-"), F.lit(">"))


def warc_text(dedup: DataFrame, date: str = DATE) -> DataFrame:
    """One WARC record per row, without the CRLF CRLF that ends it."""
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "),
                    F.col("bytes").cast("string"), F.lit(CRLF + CRLF))
    revisit = F.col("payload").isNull()
    block = F.when(revisit, http.cast("binary")).otherwise(F.concat(http.cast("binary"), F.col("payload")))
    fixed = F.concat_ws(
        CRLF, F.lit("WARC/1.1"),
        F.concat(F.lit("WARC-Type: "), F.when(revisit, "revisit").otherwise("response")),
        F.concat(F.lit("WARC-Record-ID: "), _record_id(F.col("key"), F.col("target"), F.col("digest"))),
        F.lit(f"WARC-Date: {date}"),
        F.concat(F.lit("WARC-Target-URI: "), _uri("target")),
        F.concat(F.lit("WARC-Payload-Digest: sha1:"), F.col("digest")),
        F.concat(F.lit("X-Capture-Key: "), F.col("key").cast("string")),
        F.when(revisit, F.concat(F.lit("WARC-Refers-To: "), _record_id(F.col("original"), F.col("original_target"), F.col("digest")))),
        F.when(revisit, F.concat(F.lit("WARC-Refers-To-Target-URI: "), _uri("original_target"))),
        F.when(revisit, F.lit(f"WARC-Refers-To-Date: {date}")),
        F.when(revisit, F.lit(f"WARC-Profile: {REVISIT_PROFILE}")),
        F.lit(f"Content-Type: {HTTP_TYPE}"),
        F.concat(F.lit("Content-Length: "), F.octet_length(block).cast("string")))
    return dedup.select(F.concat(fixed.cast("binary"), F.lit((CRLF + CRLF).encode()), block).cast("string").alias("value"))


def write_archives(dedup: DataFrame, path: str, records_per_archive: int) -> str:
    """Write the records below `path`, at most `records_per_archive` a file."""
    (warc_text(dedup).write.option("lineSep", CRLF + CRLF).option("compression", "gzip")
     .option("maxRecordsPerFile", records_per_archive).text(path))
    return path


def records_per_archive(captures: DataFrame, archive_bytes: int = ARCHIVE_BYTES) -> int:
    """How many records of mean size an archive of `archive_bytes` holds."""
    mean = captures.agg(F.avg("bytes")).first()[0] or 0
    return max(1, int(archive_bytes / (mean + 800)))


def parse_records(stream: BinaryIO) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers, block) of each record of an uncompressed archive, by Content-Length."""
    while line := stream.readline():
        if not line.startswith(b"WARC/"):
            raise ValueError(f"no WARC record starts with {line[:40]!r}")
        headers: dict[str, str] = {}
        while (line := stream.readline()) not in (b"\r\n", b""):
            name, _, value = line.decode("utf-8", "replace").partition(":")
            headers[name.strip().lower()] = value.strip()
        length = int(headers["content-length"])
        block = stream.read(length)
        if len(block) < length or stream.read(4) != b"\r\n\r\n":
            raise ValueError(f"record {headers.get('warc-record-id')} is cut short")
        yield headers, block


_READ = ("key string, record_id string, record_type string, target string, digest string, "
         "refers_to_id string, bytes long, payload binary")


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """One row per record of the archives below `path` (gzip or plain). A response's digest
    is taken from its payload; one that differs from its header fails the read."""
    common.bounded_batches(spark)
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [x.split()[0] for x in _READ.split(", ")]
        kinds = [pa.int64() if n == "bytes" else pa.binary() if n == "payload" else pa.string() for n in names]
        for batch in batches:
            for data in batch.column(0):
                data = data.as_py()
                stream = io.BytesIO(data)
                rows, held = [], 0
                for h, block in parse_records(gzip.open(stream) if data[:2] == b"\x1f\x8b" else stream):
                    http, _, payload = block.partition(b"\r\n\r\n")
                    revisit = h["warc-type"] == "revisit"
                    digest = h["warc-payload-digest"].removeprefix("sha1:")
                    if not revisit and digest != base64.b32encode(hashlib.sha1(payload).digest()).decode():
                        raise ValueError(f"digest of {h['warc-record-id']} differs from its payload")
                    rows.append((h.get("x-capture-key"), h["warc-record-id"], h["warc-type"], h.get("warc-target-uri"),
                                 digest, h.get("warc-refers-to"), None if revisit else len(payload),
                                 None if revisit else payload))
                    held += len(payload)
                    if held >= common.BATCH_BYTES:
                        yield _batch(rows, names, kinds)
                        rows, held = [], 0
                if rows:
                    yield _batch(rows, names, kinds)

    return files.select("content").mapInArrow(read, _READ)


def _batch(rows: list[tuple], names: list[str], kinds: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)


def resolve(read: DataFrame) -> DataFrame:
    """Each record with the length and key of the response that it refers to (a response
    refers to itself). Responses are reduced by digest and joined by record id: as in
    `originals`, the join can split a response that very many revisits refer to."""
    response = read.where("record_type = 'response'").groupBy("digest").agg(
        F.min(F.struct("record_id", "key", "bytes")).alias("r")).select(
        F.col("r.record_id").alias("found"), F.col("r.key").alias("response_key"),
        F.col("r.bytes").alias("response_bytes"))
    return read.join(response, F.coalesce("refers_to_id", "record_id") == F.col("found"), "left").drop("found")


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deduplicate the pages into archives in the shared folder and read them back."""
    captures = records(common.table(spark, sf_dir, "pages"))
    path = write_archives(deduplicated(captures), common.scratch(spark, "warc"),
                          records_per_archive(captures))
    found = resolve(read_archives(spark, path).drop("payload"))
    return found.select(
        F.col("key").cast("long").alias("page_id"),
        F.coalesce("bytes", "response_bytes").alias("payload_bytes"),
        F.col("digest").alias("payload_digest"), "record_type",
        F.when(F.col("record_type") == "revisit", F.col("response_key").cast("long")).alias("refers_to"))
