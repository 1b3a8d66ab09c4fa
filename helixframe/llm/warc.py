"""WARC archives: a writer with one gzip member per record and a splittable
reader.

The writer lets Spark's text sink commit the files (retried and speculative
tasks leave no part behind): a row's value is a whole gzip member, and the
line separator is an empty gzip member, so a file is a plain multi-member
gzip file.  Repeated payloads become revisit records.

The reader lists files with their lengths and cuts them into byte ranges.  A
task scans its range for the gzip magic, validates a candidate by decoding
it (gzip header, a WARC version line, header fields, a body as long as
Content-Length says, the member's checksum), and owns the records that start
inside its range, reading on past the end for the last one.  Ranges are read
through pyarrow's filesystems, so any store it knows will do.
"""

from __future__ import annotations

import gzip
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from .common import whole

MAGIC = b"\x1f\x8b\x08"
#: Twenty bytes: a gzip member that holds nothing.
EMPTY_MEMBER = gzip.compress(b"", mtime=0)
RANGE_BYTES = 16 << 20
READ_BYTES = 1 << 20
MOST_TASKS = 20_000
#: Payloads of this size or more are stored once.
REVISIT_BYTES = 1000
LEVEL = 6
_URN = "urn:page:"


def with_revisits(pages: DataFrame, least: int = REVISIT_BYTES) -> DataFrame:
    """page_id, url, payload, payload_digest, record_type, refers_to.  Of
    equal payloads of at least ``least`` bytes that of the largest page_id is
    the response.  Payloads meet by SHA-256; the holders are found by an
    aggregation of digests alone, combined before the shuffle."""
    body = F.encode(whole("html"), "UTF-8")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                        body.alias("payload"))
    rows = rows.withColumn("key", F.when(F.octet_length("payload") >= least, F.sha2("payload", 256)))
    holders = (rows.where(F.col("key").isNotNull()).groupBy("key")
               .agg(F.max("page_id").alias("holder"), F.count(F.lit(1)).alias("n")).where("n > 1")
               .select(F.col("key").alias("held"), "holder"))
    # small pages meet nothing; a key of their own spreads them instead of gathering all nulls in one task
    own = F.concat(F.lit("-"), F.xxhash64("page_id", "url").cast("string"))
    out = rows.withColumn("key", F.coalesce("key", own)).join(holders, F.col("key") == F.col("held"), "left")
    revisit = F.col("holder").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("holder"))
    return out.select("page_id", "url", "payload", F.sha1("payload").alias("payload_digest"),
                      F.when(revisit, "revisit").otherwise("response").alias("record_type"),
                      F.when(revisit, F.col("holder")).alias("refers_to"))


def _record(page_id, url, payload: bytes, digest: str, kind: str, refers_to) -> bytes:
    head = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <{_URN}{'' if page_id is None else page_id}>",
            f"WARC-Payload-Digest: sha1:{digest}", f"X-Payload-Length: {len(payload)}"]
    if url is not None:  # percent-encoded line breaks keep a header field on its line
        head.append("WARC-Target-URI: " + url.replace("%", "%25").replace("\r", "%0D").replace("\n", "%0A"))
    if kind == "revisit":
        head += [f"WARC-Refers-To: <{_URN}{refers_to}>",
                 "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
        payload = b""
    head.append(f"Content-Length: {len(payload)}")
    return gzip.compress("\r\n".join(head).encode() + b"\r\n\r\n" + payload + b"\r\n\r\n", LEVEL, mtime=0)


def write_warc(pages: DataFrame, path: str, least: int = REVISIT_BYTES) -> None:
    """Write one record per page under ``path``.  A null html is an empty
    payload, a null url leaves its field out; other columns are not written."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 64):
                rows = batch.slice(lo, 64).to_pylist()
                yield pa.RecordBatch.from_arrays([pa.array([_record(*r.values()) for r in rows], pa.binary())], names=["member"])

    members = with_revisits(pages, least).mapInArrow(run, "member binary")
    (members.select(F.col("member").cast("string").alias("value")).write.mode("errorifexists")
     .option("encoding", "ISO-8859-1").option("lineSep", EMPTY_MEMBER.decode("ISO-8859-1")).text(path))


def _parse(data: bytes) -> dict | None:
    """The record of a decoded member; None if it is none."""
    head, sep, body = data.partition(b"\r\n\r\n")
    lines = head.split(b"\r\n")
    if not sep or not lines[0].startswith(b"WARC/1."):
        return None
    fields = {}
    for line in lines[1:]:
        name, colon, value = line.partition(b":")
        if not colon:
            return None
        fields[name.strip().lower().decode("latin-1")] = value.strip().decode("utf-8", "replace")
    try:
        size = int(fields["content-length"])
    except (KeyError, ValueError):
        return None
    if len(body) != size + 4 or body[size:] != b"\r\n\r\n":
        return None
    return {"fields": fields, "body": body[:size]}


class _Window:
    """Bytes of a file from some offset on, read as they are asked for."""

    def __init__(self, file, start: int, size: int):
        self.file, self.base, self.size, self.data = file, start, size, b""

    def at(self, offset: int, count: int) -> bytes:
        """Up to ``count`` bytes at ``offset``; fewer at the end of the file."""
        have = self.base + len(self.data)
        if offset + count > have and have < self.size:
            want = min(max(READ_BYTES, offset + count - have), self.size - have)
            self.file.seek(have)
            self.data += self.file.read(want)
        lo = offset - self.base
        return self.data[lo:lo + count]

    def drop(self, offset: int) -> None:
        """Forget what lies before ``offset``."""
        if offset - self.base >= READ_BYTES:
            self.data = self.data[offset - self.base:]
            self.base = offset


def _member(window: _Window, offset: int) -> tuple[bytes, int] | None:
    """Decode the gzip member at ``offset``: its content and the offset after
    it; None if there is none.  A candidate that is no WARC record is given
    up once its first bytes are decoded."""
    engine, parts, at = zlib.decompressobj(31), [], offset
    try:
        while not engine.eof:
            raw = window.at(at, READ_BYTES)
            if not raw:
                return None
            part = engine.decompress(raw)
            at += len(raw)
            if part:
                if not parts and not b"WARC/1.".startswith(part[:7]) and not part.startswith(b"WARC/1."):
                    return None
                parts.append(part)
    except zlib.error:
        return None
    return b"".join(parts), at - len(engine.unused_data)


def scan_range(file, size: int, start: int, end: int) -> Iterator[tuple[int, dict]]:
    """(offset, record) of the records that start in [start, end)."""
    window, at = _Window(file, start, size), start
    while at < end:
        found = None
        if window.at(at, 3) == MAGIC and (found := _member(window, at)):
            content, after = found
            record = _parse(content)
            if content and record is None:
                found = None
            elif content:
                yield at, record
        if found:
            at = after
        else:  # no member here: on to the next magic
            at += 1
            while at < end:
                chunk = window.at(at, READ_BYTES)
                if len(chunk) < 3:
                    return
                hit = chunk.find(MAGIC)
                if hit >= 0:
                    at += hit
                    break
                at += len(chunk) - 2
                window.drop(at)
        window.drop(at)


READ_SCHEMA = ("file string, offset long, record_type string, record_id string, target_uri string, "
               "payload_digest string, payload_length long, refers_to string, payload binary")


def read_warc(spark: SparkSession, path: str, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """One row per record of the archives under ``path``.  An empty folder or
    file gives no row; bytes between members are skipped."""
    files = spark.read.format("binaryFile").load(path).select("path", "length")
    ranges = files.select("path", "length", F.explode(F.expr(
        f"sequence(0L, greatest(length - 1, 0L), {int(range_bytes)}L)")).alias("start"))
    ranges = ranges.where("length > 0")
    # as many tasks as ranges: the few bytes of these rows must not make one task of them
    ranges = ranges.repartition(min(MOST_TASKS, max(1, ranges.count())))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        for batch in batches:
            for name, size, start in zip(*[c.to_pylist() for c in batch.columns]):
                store, inner = fs.FileSystem.from_uri(name.replace("file:/", "file:///", 1) if name.startswith(
                    "file:/") and not name.startswith("file://") else name)
                rows, held = [], 0
                with store.open_input_file(inner) as file:
                    for offset, r in scan_range(file, size, start, start + range_bytes):
                        f = r["fields"]
                        uri = f.get("warc-target-uri")
                        rows.append((name, offset, f.get("warc-type"), f.get("warc-record-id"),
                                     uri and uri.replace("%0A", "\n").replace("%0D", "\r").replace("%25", "%"),
                                     f.get("warc-payload-digest"), int(f.get("x-payload-length", len(r["body"]))),
                                     f.get("warc-refers-to"), r["body"]))
                        held += len(r["body"])
                        if held >= READ_BYTES:
                            yield _batch(rows)
                            rows, held = [], 0
                if rows:
                    yield _batch(rows)

    return ranges.mapInArrow(run, READ_SCHEMA)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    types = [pa.string(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)],
                                      names=[c.split()[0] for c in READ_SCHEMA.split(", ")])


def page_records(records: DataFrame) -> DataFrame:
    """The page ids and digests of records that write_warc wrote.  For a
    response the digest is worked out anew from the payload read."""
    page = F.regexp_extract("record_id", rf"^<{_URN}(-?[0-9]*)>$", 1)
    refers = F.regexp_extract("refers_to", rf"^<{_URN}(-?[0-9]+)>$", 1)
    response = F.col("record_type") == "response"
    return records.select(
        F.when(page != "", page.cast("long")).alias("page_id"),
        F.when(response, F.octet_length("payload").cast("long")).otherwise(F.col("payload_length")).alias("payload_bytes"),
        F.when(response, F.sha1("payload")).otherwise(F.regexp_replace("payload_digest", "^sha1:", "")).alias("payload_digest"),
        "record_type", F.when(F.col("refers_to").isNotNull(), refers.cast("long")).alias("refers_to"))


def round_trip(pages: DataFrame) -> DataFrame:
    """Write the pages to archives in the shared folder and read them back.
    One row per page, repeated rows too: page_id, payload_bytes,
    payload_digest, record_type, refers_to.  An empty table gives no row."""
    spark = pages.sparkSession
    path = scratch_path(spark, f"warc-{uuid.uuid4().hex}")
    write_warc(pages, path)
    return page_records(read_warc(spark, path))
