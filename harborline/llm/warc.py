"""Dictionary-compressed web archives.

Every page becomes one WARC 1.1 record. Each record is a Zstandard frame of its own,
compressed with a dictionary that was built from a bounded sample of the records. The
dictionary leads every file in a skippable frame, so a file can be read on its own,
and any record can be decompressed without those before it.

Files are written by Spark's text writer, whose committer survives lost tasks and works
on every store: one row is one file, made of the dictionary and the frames that follow it, and the
line separator is an empty skippable frame, which readers of the format pass over. A task rolls
to a new file when the frames pass ``ROLL_BYTES``, so a file, which is read back as one value, has
at most that size and one record more, whatever the size of a split.

Pages with equal payloads of at least ``MIN_BYTES``: the one with the largest id is written as
response, the others as revisit records, whose block keeps the HTTP header (and so the
payload's length) and whose header names the response and the payload's digest. Equality
is decided by SHA-256, beside the SHA-1 that the archive carries. Groups are counted
on narrow rows with a partial aggregate; only groups of two and more are joined back.

Defined results: a null payload is empty. A null id sorts below every other id; rows that
share the largest id of a group are all responses, since a record cannot revisit its own
id; a group whose ids are all null has responses only. Null urls become ``urn:none``, blanks
and control characters of a url are percent-encoded. A table with no rows writes no archive
and reads back as no rows. Samples too small to train a dictionary are used as they are. Payloads of any length are
written whole. Other columns play no part, whatever their names.
"""

from __future__ import annotations

import base64
import struct
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from harborline.llm.frames import sampled, staged
from harborline.operators.storage import shared_path

MIN_BYTES = 1000
SAMPLE_ROWS = 2000  # records the dictionary is built from
SAMPLE_BYTES = 8192  # of each of them
DICTIONARY_BYTES = 65536
LEVEL = 3
ROLL_BYTES = 64 << 20  # compressed bytes after which a task begins a new file
DATE = "2000-01-01T00:00:00Z"
# Fixed values of the formats: the magic numbers of skippable frames, the profile's name.
DICTIONARY_MAGIC = 0x184D2A5D
SEPARATOR = "P*M\x18\x00\x00\x00\x00"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

RECORD = ("page_id bigint, url string, record_type string, refers_to bigint, payload_bytes bigint, "
          "payload_digest string, payload binary")


def record_types(pages: DataFrame, min_bytes: int = MIN_BYTES) -> DataFrame:
    """``page_id``, ``url``, ``payload``, ``sha1``, ``refers_to`` (null for responses)."""
    payload = F.coalesce(F.encode(F.col("html").cast("string"), "UTF-8"), F.lit(b""))
    rows = pages.select(F.col("page_id").cast("bigint"), F.col("url").cast("string"), payload.alias("payload"))
    rows = rows.select("*", F.unhex(F.sha2("payload", 256)).alias("_key"))
    sizes = rows.filter(F.octet_length("payload") >= min_bytes)
    first = sizes.groupBy("_key").agg(F.max("page_id").alias("first"), F.count(F.lit(1)).alias("n"))
    first = staged(first.filter("n > 1 AND first IS NOT NULL").drop("n"), "repeated-payloads")
    refers = F.when(~F.col("first").eqNullSafe(F.col("page_id")), F.col("first"))
    return rows.join(first, "_key", "left").select(
        "page_id", "url", "payload", F.sha1("payload").alias("sha1"), refers.alias("refers_to"))


def _target(url: str | None) -> str:
    if not url:
        return "urn:none"
    return "".join(c if " " < c and c != "\x7f" else "".join(f"%{b:02X}" for b in c.encode()) for c in url)


def _record_id(page_id: int | None, sha1: str) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}:{sha1}>"


def record(page_id: int | None, url: str | None, payload: bytes, sha1: str, refers_to: int | None) -> bytes:
    """One record with its header and closing blank lines."""
    http = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
            f"Content-Length: {len(payload)}\r\n\r\n").encode()
    block = http if refers_to is not None else http + payload
    digest = base64.b32encode(bytes.fromhex(sha1)).decode()
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: {_record_id(page_id, sha1)}",
        f"WARC-Date: {DATE}",
        f"WARC-Target-URI: {_target(url)}",
        f"WARC-Payload-Digest: sha1:{digest}",
    ]
    if refers_to is not None:
        lines += [f"WARC-Profile: {REVISIT_PROFILE}", f"WARC-Refers-To: {_record_id(refers_to, sha1)}"]
    lines += ["Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def build_dictionary(typed: DataFrame, total: int, rows: int = SAMPLE_ROWS, size: int = DICTIONARY_BYTES) -> bytes:
    """A dictionary from a sample of about ``rows`` of ``total`` records, chosen by the hash of digest and id.

    Of a long payload the sample holds ``SAMPLE_BYTES`` at a place chosen by another hash of both.
    What reaches the driver is at most twice ``rows`` times ``SAMPLE_BYTES``, whatever the size of the table.
    """
    room = F.greatest(F.octet_length("payload") - SAMPLE_BYTES, F.lit(0))
    start = F.pmod(F.xxhash64(F.lit("place"), "sha1", "page_id"), room + 1).cast("int") + 1
    part = typed.filter("refers_to IS NULL").select(
        "page_id", "url", F.substring("payload", start, F.lit(SAMPLE_BYTES)).alias("payload"), "sha1")
    chosen = sampled(part, rows, total, "sha1", "page_id")
    sample = sorted(chosen.limit(2 * rows).collect(), key=lambda r: (r.sha1, str(r.page_id), str(r.url)))
    records = [record(r.page_id, r.url, bytes(r.payload), r.sha1, None) for r in sample]
    try:
        return zstandard.train_dictionary(size, records).as_bytes()
    except zstandard.ZstdError:  # too few or too short records
        return b"".join(records)[-size:]


def skippable(content: bytes) -> bytes:
    """The leading frame that holds the dictionary."""
    return struct.pack("<II", DICTIONARY_MAGIC, len(content)) + content


def write_archives(pages: DataFrame, path: str, min_bytes: int = MIN_BYTES, level: int = LEVEL,
                   roll_bytes: int = ROLL_BYTES) -> None:
    """Write all pages as archives of about ``roll_bytes`` and less below ``path``."""
    typed = record_types(pages, min_bytes)
    content = build_dictionary(typed, pages.count())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compressor = zstandard.ZstdCompressor(level=level, dict_data=zstandard.ZstdCompressionDict(content))
        frames, size = [], 0
        for batch in batches:
            columns = [batch.column(n) for n in ("page_id", "url", "payload", "sha1", "refers_to")]
            for values in zip(*columns):
                frames.append(compressor.compress(record(*[v.as_py() for v in values])))
                size += len(frames[-1])
                if size >= roll_bytes:
                    yield archive(frames)
                    frames, size = [], 0
        if frames:
            yield archive(frames)

    def archive(frames: list[bytes]) -> pa.RecordBatch:
        whole = b"".join([skippable(content), *frames])
        return pa.RecordBatch.from_arrays([pa.array([whole], pa.binary())], names=["archive"])

    archives = typed.mapInArrow(run, "archive binary").select(F.col("archive").cast("string"))
    archives.write.option("lineSep", SEPARATOR).option("maxRecordsPerFile", 1).text(path)


def _frames(data: bytes) -> Iterator[bytes]:
    """The decompressed records of one file."""
    view, at = memoryview(data), 0
    decompressor = zstandard.ZstdDecompressor()
    while at < len(view):
        magic, size = struct.unpack_from("<II", view, at)
        if magic & 0xFFFFFFF0 == 0x184D2A50:  # skippable
            at += 8 + size
            if magic == DICTIONARY_MAGIC:
                dictionary = zstandard.ZstdCompressionDict(bytes(view[at - size:at]))
                decompressor = zstandard.ZstdDecompressor(dict_data=dictionary)
            continue
        one, out = decompressor.decompressobj(), []
        while not one.eof:
            piece = view[at:at + 32768]
            if not piece:
                raise ValueError("the archive ends inside a frame")
            out.append(one.decompress(piece))
            at += len(piece) - len(one.unused_data)
        yield b"".join(out)


def parse(data: bytes) -> tuple:
    """The fields of ``RECORD`` from one record."""
    head, _, rest = data.partition(b"\r\n\r\n")
    version, *lines = head.decode().split("\r\n")
    if not version.startswith("WARC/"):
        raise ValueError("not a WARC record")
    fields = {name.strip().lower(): value.strip() for name, _, value in (line.partition(":") for line in lines)}
    block = rest[:int(fields["content-length"])]
    if rest[len(block):] != b"\r\n\r\n":
        raise ValueError("the record's length is wrong")
    http, _, payload = block.partition(b"\r\n\r\n")
    kind = fields["warc-type"]
    length = int(next(x for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:")).split(b":")[1])
    if kind == "response" and len(payload) != length:
        raise ValueError("the payload's length is wrong")

    def page(name: str) -> int | None:
        number = fields[name].strip("<>").split(":")[2] if name in fields else ""
        return int(number) if number else None

    digest = base64.b32decode(fields["warc-payload-digest"].partition(":")[2]).hex()
    url = fields["warc-target-uri"]
    return (page("warc-record-id"), None if url == "urn:none" else url, kind, page("warc-refers-to"), length, digest,
            payload if kind == "response" else None)


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """All records below ``path``, one row each; revisits have no payload of their own."""
    names = [field.split()[0] for field in RECORD.split(", ")]
    types = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.binary()]

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, size = [], 0
        for files in batches:
            for content in files.column("content"):
                for data in _frames(content.as_buffer()):
                    rows.append(parse(data))
                    size += len(data)
                    if size > 4 << 20:
                        yield batch(rows)
                        rows, size = [], 0
        if rows:
            yield batch(rows)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    return files.select("content").mapInArrow(run, RECORD)


def archive_round_trip(pages: DataFrame, path: str | None = None) -> DataFrame:
    """Write the pages, read the archives back and check every response against its digest."""
    spark = pages.sparkSession
    path = path or shared_path(spark, "archives")
    write_archives(pages, path)
    rows = read_archives(spark, path)
    wrong = F.col("payload").isNotNull() & (F.sha1("payload") != F.col("payload_digest"))
    digest = F.when(wrong, F.raise_error(F.lit("a payload does not match its digest"))).otherwise(
        F.col("payload_digest"))
    return rows.select("page_id", "payload_bytes", digest.alias("payload_digest"), "record_type", "refers_to")
