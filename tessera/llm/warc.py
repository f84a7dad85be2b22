"""WARC archives: a writer and a splittable reader of gzip-member-per-record files.

*Writer.*  Payload digests are computed JVM-side; of equal payloads of at least
``revisit_bytes`` bytes the row with the largest id is archived as a response,
the others as revisits that refer to it (the largest id per digest is a
map-side combined maximum, so a payload shared by a third of all pages is one
row per task).  Each task writes one archive; every record is a gzip member of
its own.  A revisit's block is the HTTP header alone, whose ``Content-Length``
keeps the size of the full payload.

*Reader.*  The archives are cut into byte ranges, one row and task slice each.
A task scans its range for the gzip magic, validates a candidate by inflating
its first bytes and decoding the record's version line and headers, and owns
every record whose member starts inside its range; the last one may end
beyond it.  After an owned record the next member starts where the last ended,
so only the first record of a range is searched for.  Neighbouring ranges
therefore yield every record exactly once, whatever the split size.

Defined results: a null or empty html is an empty payload (a response); a null
url gives a record without target; line breaks in urls are percent-encoded;
rows repeated with the largest id and equal payload are responses each; an
empty table writes no archive and gives an empty result.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import scratch_path, written
from tessera.llm.files import AtomicFile, open_random

REVISIT_BYTES = 1000  # fixed value of the contract
SPLIT_BYTES = 4 << 20
_READ = 1 << 16
_MAGIC = b"\x1f\x8b\x08"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def plan_records(pages: DataFrame, id_col: str = "page_id", payload_col: str = "html", revisit_bytes: int = REVISIT_BYTES) -> DataFrame:
    """``pages`` as ``_id, _url?, _payload, _sha1, _refers`` (null: archived as a response)."""
    payload = F.coalesce(F.col(payload_col), F.lit("")).cast("binary")
    rows = pages.select(
        F.col(id_col).alias("_id"),
        (F.col("url") if "url" in pages.columns else F.lit(None).cast("string")).alias("_url"),
        payload.alias("_payload"), F.sha1(payload).alias("_sha1"),
    )
    large = F.octet_length("_payload") >= revisit_bytes
    leads = rows.where(large).groupBy("_sha1").agg(F.max("_id").alias("_lead"), F.count("*").alias("_n")).where("_n > 1")
    joined = rows.join(leads.select("_sha1", "_lead"), "_sha1", "left")
    return joined.select(
        "_id", "_url", "_payload", "_sha1", F.when(large & (F.col("_id") < F.col("_lead")), F.col("_lead")).alias("_refers")
    )


def _urn(ident) -> str:
    return f"<urn:page:{'null' if ident is None else ident}>"


def record(ident, url: str | None, payload: bytes, sha1: str, refers, date: str) -> bytes:
    """One WARC/1.1 record."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers is not None else http + payload
    digest = base64.b32encode(bytes.fromhex(sha1)).decode()
    head = [
        "WARC/1.1", f"WARC-Type: {'response' if refers is None else 'revisit'}", f"WARC-Record-ID: {_urn(ident)}",
        f"WARC-Date: {date}", "Content-Type: application/http;msgtype=response",
        f"WARC-Payload-Digest: sha1:{digest}", f"Content-Length: {len(block)}",
    ]
    if url is not None:
        head.append("WARC-Target-URI: " + url.replace("\r", "%0D").replace("\n", "%0A"))
    if refers is not None:
        head += [f"WARC-Refers-To: {_urn(refers)}", f"WARC-Profile: {_PROFILE}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def write(
    pages: DataFrame, folder: str, id_col: str = "page_id", payload_col: str = "html",
    revisit_bytes: int = REVISIT_BYTES, date: str = "2024-01-01T00:00:00Z", level: int = 6,
) -> DataFrame:
    """Write the archives of ``pages`` to ``folder``; returns the manifest ``file, bytes, records``."""
    planned = plan_records(pages, id_col, payload_col, revisit_bytes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        first = next((b for b in batches if b.num_rows), None)
        if first is None:
            return
        target = AtomicFile(folder, f"part-{TaskContext.get().partitionId():06d}.warc.gz")
        size = records = 0
        with target as sink:
            batch = first
            while batch is not None:
                for k in range(0, batch.num_rows, 64):
                    for ident, url, payload, sha1, refers in zip(*(c.to_pylist() for c in batch.slice(k, 64).columns), strict=True):
                        pack = zlib.compressobj(level, zlib.DEFLATED, 31)
                        member = pack.compress(record(ident, url, payload, sha1, refers, date)) + pack.flush()
                        sink.write(member)
                        size += len(member)
                        records += 1
                batch = next(batches, None)
        yield pa.RecordBatch.from_arrays([pa.array([target.uri]), pa.array([size]), pa.array([records])], names=["file", "bytes", "records"])

    return written(planned.mapInArrow(run, "file string, bytes long, records long"), "manifest")


class _Source:
    """Buffered reads of a file at growing offsets."""

    def __init__(self, uri: str, size: int):
        self.file, self.size, self.at, self.data = open_random(uri), size, 0, b""

    def get(self, start: int, n: int) -> bytes:
        """Up to ``n`` bytes from ``start``; empty at the end of the file."""
        if not self.at <= start <= self.at + len(self.data) - min(n, self.size - start):
            self.file.seek(start)
            self.at, self.data = start, self.file.read(min(max(n, 4 * _READ), self.size - start))
        return self.data[start - self.at : start - self.at + n]


def _headers(data: bytes) -> tuple[dict[str, str], int] | None:
    """Header fields of a record and the length of its head; None when ``data`` does not begin with one."""
    if not data.startswith(b"WARC/"):
        return None
    end = data.find(b"\r\n\r\n")
    if end < 0:
        return None
    lines = data[:end].decode("utf-8", "replace").split("\r\n")
    fields = {}
    for line in lines[1:]:
        name, colon, value = line.partition(":")
        if not colon:
            return None
        fields[name.strip().lower()] = value.strip()
    return (fields, end + 4) if {"warc-type", "content-length", "warc-record-id"} <= fields.keys() else None


def _member(source: _Source, start: int) -> tuple[bytes, int] | None:
    """The record in the gzip member at ``start`` and the member's end; None when there is no such member."""
    unpack, out, at = zlib.decompressobj(31), [], start
    head_seen = False
    while not unpack.eof:
        part = source.get(at, _READ)
        if not part:
            return None
        try:
            out.append(unpack.decompress(part))
        except zlib.error:
            return None
        at += len(part)
        if not head_seen and sum(map(len, out)) >= 5:
            if not b"".join(out).startswith(b"WARC/"):
                return None
            head_seen = True
    return b"".join(out), at - len(unpack.unused_data)


def records_in(uri: str, size: int, start: int, end: int) -> Iterator[tuple[int, dict[str, str], bytes]]:
    """``(offset, headers, block)`` of every record whose gzip member starts in ``[start, end)``."""
    source, at, searching = _Source(uri, size), start, True
    while at < min(end, size):
        if searching:
            window = source.get(at, _READ)
            hit = window.find(_MAGIC)
            if hit < 0:  # the magic may lie across the border of two windows
                at += max(1, len(window) - len(_MAGIC) + 1)
                continue
            at += hit
            if at >= end:
                return
        found = _member(source, at)
        parsed = _headers(found[0]) if found else None
        if parsed is None:
            at, searching = at + 1, True
            continue
        fields, head = parsed
        yield at, fields, found[0][head : head + int(fields["content-length"])]
        at, searching = found[1], False


def splits(spark: SparkSession, manifest: DataFrame, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """``file, bytes, start, end``: the byte ranges of the archives, dealt to tasks."""
    width = F.lit(split_bytes)
    ranges = manifest.where("bytes > 0").select(
        "file", "bytes", F.explode(F.sequence(F.lit(0).cast("long"), F.col("bytes") - 1, width.cast("long"))).alias("start")
    ).withColumn("end", F.least(F.col("start") + width, "bytes"))
    return ranges.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "file", "start")


def _ident(urn: str):
    text = urn.strip("<>").rpartition(":")[2]
    return None if text == "null" else text


def read(spark: SparkSession, manifest: DataFrame, split_bytes: int = SPLIT_BYTES, with_payload: bool = False) -> DataFrame:
    """One row per record: ``page_id`` (string), ``payload_bytes, payload_digest, record_type, refers_to`` (string), ``file, offset``.

    Responses are measured on the payload read; revisits report the digest of
    the record and the size in their HTTP header.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, size, start, end in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                rows, held = [], 0
                for offset, fields, block in records_in(file, size, start, end):
                    http, _, payload = block.partition(b"\r\n\r\n")
                    kind, refers = fields["warc-type"], fields.get("warc-refers-to")
                    if kind == "revisit":
                        lengths = [x.partition(b":")[2] for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:")]
                        measured = int(lengths[0]), base64.b32decode(fields["warc-payload-digest"].partition(":")[2]).hex()
                    else:
                        measured = len(payload), hashlib.sha1(payload).hexdigest()
                    rows.append((_ident(fields["warc-record-id"]), *measured, kind, None if refers is None else _ident(refers),
                                 file, offset, payload if with_payload else None))
                    held += len(payload) if with_payload else 0
                    if held > 4 << 20:
                        yield _batch(rows)
                        rows, held = [], 0
                yield _batch(rows)

    found = splits(spark, manifest, split_bytes).mapInArrow(run, _RECORD_SCHEMA)
    return found if with_payload else found.drop("payload")


_RECORD_SCHEMA = (
    "page_id string, payload_bytes long, payload_digest string, record_type string, refers_to string, "
    "file string, offset long, payload binary"
)
_RECORD_TYPES = [pa.string(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.binary()]


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    cols = list(zip(*rows, strict=True)) if rows else [()] * len(_RECORD_TYPES)
    names = [c.split()[0] for c in _RECORD_SCHEMA.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, _RECORD_TYPES, strict=True)], names=names)


def round_trip(
    pages: DataFrame, id_col: str = "page_id", payload_col: str = "html",
    revisit_bytes: int = REVISIT_BYTES, split_bytes: int = SPLIT_BYTES,
) -> DataFrame:
    """Archive ``pages`` in the shared scratch folder and read the records back."""
    spark = pages.sparkSession
    kind = pages.select(F.col(id_col)).schema[0].dataType
    manifest = write(pages, f"{scratch_path(spark, 'warc')}/files", id_col, payload_col, revisit_bytes)
    found = read(spark, manifest, split_bytes)
    return found.select(
        F.col("page_id").cast(kind).alias(id_col), "payload_bytes", "payload_digest", "record_type",
        F.col("refers_to").cast(kind).alias("refers_to"), "offset",
    )
