"""Legacy archive (ARC) to WARC conversion, writing and reading.

An ARC file opens with a version block whose third line names the fields of the record headers
that follow (version 1: five fields, version 2: ten). ``parse_arc`` reads that definition, then
each header line and exactly the declared number of bytes, so payloads may hold anything.
``to_warc`` synthesises the equivalent WARC record: an identifier derived from the record's key,
an ISO date from the 14-digit one, the type (``response``, or ``revisit`` of an equal payload)
and SHA-256 digests. WARC archives are written and read by Spark's own writers and readers, so
any file system will do; every file is gzip-compressed. Files are cut by bytes: records are
joined to bundles of about BUNDLE_BYTES (a larger record is one of its own) and a file holds
BUNDLES of them. They are read back as a stream, in batches of bounded bytes.

Defined cases: a null payload is an empty one; a row with a null key is written as a response with
an empty key, read back as null, and takes no part in the choice of revisits; a null or blank url becomes ``urn:none``; blanks
and controls in urls are percent-encoded, and headers stay one line; a truncated ARC record, a wrong length or
a digest that does not fit its payload raise an error; rows that repeat a key and its payload
are each written alike; an empty table writes no record and reads back none; extra columns are
ignored.
"""

from __future__ import annotations

import gzip
import hashlib
import io
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.util import cut_lineage
from ..session import ensure_checkpoint_dir
from .common import map_arrow

# fixed values: the header definitions of the two ARC versions
ARC_FIELDS = {
    1: "URL IP-address Archive-date Content-type Archive-length",
    2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename "
       "Archive-length",
}
REVISIT_PROFILE = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"
NAMESPACE = uuid.uuid5(uuid.NAMESPACE_URL, "urn:record")
MIN_REVISIT = 100              # smaller payloads are always written in full
BUNDLE_BYTES = 4 << 20         # uncompressed size of the records written as one row
BUNDLES = 8                    # rows of a WARC file
BATCH_BYTES = 4 << 20          # payload bytes of a batch of records read
CAPTURED = "20200101000000"    # capture date of tables that have none


@dataclass
class ArcRecord:
    """One ARC record: its header fields by name, and its block."""

    fields: dict[str, str]
    block: bytes


def _clean(value: str | None) -> str:
    out = "".join(c if c > " " and c != "\x7f" else f"%{ord(c):02X}" for c in value or "")
    return out or "urn:none"


def write_arc(records: list[tuple[str | None, bytes]], version: int = 1,
              date: str = CAPTURED) -> bytes:
    """A whole ARC file of (url, block) records."""
    info = f"{version} 0 archive\n{ARC_FIELDS[version]}\n\n".encode()
    head = f"filedesc://archive.arc 0.0.0.0 {date} text/plain"
    tail = "" if version == 1 else " 200 - - 0 archive.arc"
    out = [f"{head}{tail} {len(info)}\n".encode(), info]
    size = len(out[0]) + len(info)
    for url, block in records:
        mid = "" if version == 1 else f" 200 - - {size} archive.arc"
        line = f"{_clean(url)} 0.0.0.0 {date} text/html{mid} {len(block)}\n".encode()
        out += [line, block, b"\n"]
        size += len(line) + len(block) + 1
    return b"".join(out)


def parse_arc(data: bytes) -> Iterator[ArcRecord]:
    """Records of an ARC file (plain or gzip, any number of members), by declared lengths."""
    if data[:2] == b"\x1f\x8b":
        data = gzip.decompress(data)
    if not data:
        return
    if not data.startswith(b"filedesc://"):
        raise ValueError("not an ARC file: no version block")
    end = data.index(b"\n")
    length = int(data[:end].split(b" ")[-1])
    info = data[end + 1:end + 1 + length].split(b"\n")
    version = int(info[0].split(b" ")[0])
    names = info[1].decode().split()
    if version not in ARC_FIELDS or names[0] != "URL" or names[-1] != "Archive-length":
        raise ValueError(f"unknown ARC version {version} or header definition")
    at = end + 1 + length
    while at < len(data):
        if data[at:at + 1] == b"\n":      # records are set apart by newlines
            at += 1
            continue
        end = data.find(b"\n", at)
        parts = data[at:end].decode().split(" ") if end >= 0 else []
        if len(parts) != len(names):
            raise ValueError(f"ARC header at {at} has {len(parts)} of {len(names)} fields")
        length = int(parts[-1])
        block = data[end + 1:end + 1 + length]
        if len(block) != length:
            raise ValueError(f"ARC record at {at} is cut short")
        yield ArcRecord(dict(zip(names, parts)), block)
        at = end + 1 + length


def record_id(key: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(NAMESPACE, key)}>"


def warc_date(arc_date: str) -> str:
    """ISO form of a 14-digit (or 12-digit, without seconds) ARC date."""
    d = arc_date.ljust(14, "0")
    return f"{d[:4]}-{d[4:6]}-{d[6:8]}T{d[8:10]}:{d[10:12]}:{d[12:14]}Z"


def http_parts(block: bytes) -> tuple[bytes, bytes]:
    """HTTP header (with its blank line) and payload; a block without one is all payload."""
    if block.startswith(b"HTTP/"):
        head, mark, body = block.partition(b"\r\n\r\n")
        if mark:
            return head + mark, body
    return b"", block


def to_warc(record: ArcRecord, key: str, first_key: str | None = None, bare: bool = False) -> bytes:
    """The WARC record of an ARC record; ``first_key`` names the record it repeats, if any. The
    block of a ``bare`` record is all payload, even if it starts like an HTTP header."""
    head, payload = (b"", record.block) if bare else http_parts(record.block)
    status = record.fields.get("Result-code", "200")
    if not head:
        head = (f"HTTP/1.0 {status} OK\r\nContent-Type: {record.fields['Content-type']}\r\n"
                f"Content-Length: {len(payload)}\r\n\r\n").encode()
    block = head if first_key is not None else head + payload
    lines = ["WARC/1.0", f"WARC-Type: {'response' if first_key is None else 'revisit'}",
             f"WARC-Record-ID: {record_id(key)}", f"X-Record-Key: {key}",
             f"WARC-Date: {warc_date(record.fields['Archive-date'])}",
             f"WARC-Target-URI: {record.fields['URL']}",
             f"WARC-IP-Address: {record.fields['IP-address']}",
             "Content-Type: application/http; msgtype=response",
             f"WARC-Payload-Digest: sha256:{hashlib.sha256(payload).hexdigest()}",
             f"WARC-Block-Digest: sha256:{hashlib.sha256(block).hexdigest()}"]
    if first_key is not None:
        lines += [f"WARC-Profile: {REVISIT_PROFILE}", f"WARC-Refers-To: {record_id(first_key)}",
                  f"X-Refers-To-Key: {first_key}", f"X-Payload-Length: {len(payload)}"]
    lines.append(f"Content-Length: {len(block)}")
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse_warc(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers, block) of every record of a WARC file (plain or gzip, any number of members),
    unpacked record by record."""
    file = gzip.GzipFile(fileobj=io.BytesIO(data)) if data[:2] == b"\x1f\x8b" else io.BytesIO(data)
    at = 0
    while first := file.readline():
        lines = [first]
        while lines[-1].endswith(b"\r\n") and lines[-1] != b"\r\n":
            lines.append(file.readline())
        if not first.startswith(b"WARC/") or lines[-1] != b"\r\n":
            raise ValueError(f"no WARC record at {at}")
        headers = dict(x[:-2].decode().split(": ", 1) for x in lines[1:-1])
        length = int(headers["Content-Length"])
        block = file.read(length)
        if len(block) != length or file.read(4) != b"\r\n\r\n":
            raise ValueError(f"WARC record at {at} does not have its declared length")
        yield headers, block
        at += sum(map(len, lines)) + length + 4


def convert_pages(pages: DataFrame, key_col: str, url_col: str, payload_col: str) -> DataFrame:
    """(records): bundles of WARC records as text, through ARC files built of runs of rows.

    Of rows with equal payloads of at least MIN_REVISIT bytes, the smallest key's is written in
    full and the others refer to it. The choice is made on (key, digest, size) alone: digests
    are grouped map-side, so a payload with a third of all rows is one row a task.
    """
    rows = pages.select(F.col(key_col).alias("key"), F.col(url_col).cast("string").alias("url"),
                        F.coalesce(F.col(payload_col).cast("string"), F.lit("")).alias("payload"))
    rows = rows.withColumn("digest", F.sha2(F.col("payload").cast("binary"), 256))
    big = rows.where((F.octet_length("payload") >= MIN_REVISIT) & F.col("key").isNotNull()).select("key", "digest")
    first = (big.groupBy("digest").agg(F.min("key").alias("first"), F.count(F.lit(1)).alias("n"))
             .where("n > 1").drop("n"))
    again = cut_lineage(big.join(first, "digest").where(F.col("key") != F.col("first")).distinct())
    again = again.select(F.col("key").alias("k"), F.col("digest").alias("d"), "first")
    linked = rows.join(again, (F.col("key") == F.col("k")) & (F.col("digest") == F.col("d")),
                       "left").select("key", "url", "payload", "first")

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[bytes]:
        version = 2
        for batch in batches:
            version = 3 - version
            for lo, hi in _runs(pc.binary_length(batch.column(2)).to_pylist(), 256):
                part = batch.slice(lo, hi - lo)
                keys, firsts = part.column(0).to_pylist(), part.column(3).to_pylist()
                arc = write_arc([(u.as_py(), p.as_py().encode())
                                 for u, p in zip(part.column(1), part.column(2))], version)
                for rec, k, f in zip(parse_arc(arc), keys, firsts, strict=True):
                    yield to_warc(rec, "" if k is None else str(k), None if f is None else str(f), bare=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bundle, size = [], 0
        for rec in chain(records(batches), [None]):
            if bundle and (rec is None or size + len(rec) > BUNDLE_BYTES):
                out = b"".join(bundle)[:-2]         # the last line end is the writer's
                bundle, size = [], 0
                yield pa.RecordBatch.from_arrays([pa.array([out], pa.binary()).cast(pa.string())], names=["records"])
            if rec is not None:
                bundle.append(rec)
                size += len(rec)

    return linked.transform(map_arrow, run, "records string")


def _runs(sizes: list[int], most: int) -> Iterator[tuple[int, int]]:
    """Runs of at most ``most`` rows and about BUNDLE_BYTES bytes (one row at least)."""
    lo = total = 0
    for i, n in enumerate(sizes):
        if i > lo and (i - lo == most or total + n > BUNDLE_BYTES):
            yield lo, i
            lo, total = i, 0
        total += n
    if sizes:
        yield lo, len(sizes)


def convert_arc_files(files: DataFrame, content_col: str = "content", path_col: str = "path"
                      ) -> DataFrame:
    """(record: binary): WARC records of whole ARC files, as read by ``binaryFile``. Keys are the
    file's path and the record's number; every record is a response."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, data in zip(batch.column(0), batch.column(1)):
                part = [to_warc(rec, f"{path.as_py()}#{i}")
                        for i, rec in enumerate(parse_arc(data.as_py()))]
                yield pa.RecordBatch.from_arrays([pa.array(part, pa.binary())], names=["record"])

    return files.select(path_col, content_col).transform(map_arrow, run, "record binary")


def write_warc(bundles: DataFrame, path: str) -> None:
    """Write bundles of records as WARC files: the last line end of a bundle is the writer's."""
    (bundles.write.mode("overwrite").option("lineSep", "\r\n").option("compression", "gzip")
     .option("maxRecordsPerFile", BUNDLES).text(path))


def read_warc(spark, path: str, payloads: bool = True) -> DataFrame:
    """(key, url, type, digest, length, refers_key, payload) of every record under ``path``;
    without ``payloads`` the last column is left out.

    Block digests and, for responses, payload digests are checked against the bytes read.
    """
    schema = {"key": pa.string(), "url": pa.string(), "type": pa.string(), "digest": pa.string(),
              "length": pa.int64(), "refers_key": pa.string(), "payload": pa.binary()}
    if not payloads:
        del schema["payload"]

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(zip(*rows), schema.values())], names=list(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, size = [], 0
        for batch in batches:
            for data in batch.column(0):
                for h, block in parse_warc(data.as_py()):
                    head, payload = http_parts(block)
                    full = h["WARC-Type"] == "response"
                    told = h["WARC-Payload-Digest"].removeprefix("sha256:")
                    if f"sha256:{hashlib.sha256(block).hexdigest()}" != h["WARC-Block-Digest"] or \
                            full and hashlib.sha256(payload).hexdigest() != told:
                        raise ValueError(f"digest of {h['WARC-Record-ID']} does not fit")
                    row = (h["X-Record-Key"] or None, h["WARC-Target-URI"], h["WARC-Type"], told,
                           len(payload) if full else int(h["X-Payload-Length"]),
                           h.get("X-Refers-To-Key"))
                    if payloads:
                        row += (payload if full else None,)
                        size += len(payload)
                    rows.append(row)
                    if size > BATCH_BYTES or len(rows) == 4096:
                        yield batch_of(rows)
                        rows, size = [], 0
        if rows:
            yield batch_of(rows)

    names = {pa.int64(): "long", pa.binary(): "binary"}
    return (spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path)
            .select("content").transform(map_arrow, run, ", ".join(
                f"{c} {names.get(t, 'string')}" for c, t in schema.items())))


def round_trip(pages: DataFrame, key_col: str = "page_id", url_col: str = "url",
               payload_col: str = "html", payloads: bool = True) -> DataFrame:
    """Write ``pages`` as WARC archives in the shared folder and read them back."""
    spark = pages.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/warc-{uuid.uuid4().hex}"
    write_warc(convert_pages(pages, key_col, url_col, payload_col), path)
    return read_warc(spark, path, payloads)
