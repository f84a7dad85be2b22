"""File sources and sinks: CSV/TSV/zipped CSV, JSON corpora, text lines, images,
binary side-effect sinks, offline feature tables and saved pipelines."""

from __future__ import annotations

import io
import os
import re
import uuid
import zipfile

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.session import ensure_checkpoint_dir, remove_at_end


def _fs_and_path(uri: str):
    """Filesystem handle for a Spark path (``file:``, ``hdfs://``, ``s3://``, ...) via pyarrow."""
    from pyarrow import fs as pafs

    if uri.startswith("file:") and not uri.startswith("file://"):
        uri = "file://" + uri[len("file:"):]
    if "://" not in uri:
        return pafs.LocalFileSystem(), uri
    return pafs.FileSystem.from_uri(uri)


def _write_file(folder: str, name: str, data: bytes) -> None:
    fs, base = _fs_and_path(folder)
    fs.create_dir(base, recursive=True)
    with fs.open_output_stream(f"{base.rstrip('/')}/{name}") as out:
        out.write(data)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder name under the shared checkpoint folder (never a machine-local temp dir),
    removed when the application ends."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    outer = f"{base}/tessera-scratch-{name}-{uuid.uuid4().hex[:12]}"
    remove_at_end(spark, outer)
    return f"{outer}/data"


# ------------------------------------------------------------------ A1, A7

def read_table(spark: SparkSession, path: str, fmt: str = "csv", schema=None, header: bool = True,
               sep: str | None = None) -> DataFrame:
    """A1: CSV (``sep=","``) / TSV (``sep="\\t"``) with header; an explicit ``schema`` avoids
    the inference pass.  ``fmt="zip"`` reads zipped CSV members (see :func:`read_zipped_csv`)."""
    if fmt == "zip":
        return read_zipped_csv(spark, path, schema, header=header, sep=sep or ",")
    r = spark.read.option("header", header).option("sep", sep or ("\t" if fmt == "tsv" else ","))
    r = r.schema(schema) if schema is not None else r.option("inferSchema", True)
    return r.csv(path)


def read_zipped_csv(spark: SparkSession, path: str, schema: str | None = None, header: bool = True,
                    sep: str = ",") -> DataFrame:
    """A1: CSV members of zip archives.  Each archive is one file of the binary source
    (one task each); members are expanded to lines in Arrow batches and parsed with
    ``from_csv``.  Without a schema all columns are strings named from the header."""
    raw = spark.read.format("binaryFile").load(path).select("path", "content")

    def lines(it):
        for pdf in it:
            out = []
            for p, content in zip(pdf["path"], pdf["content"]):
                with zipfile.ZipFile(io.BytesIO(content)) as zf:
                    for name in zf.namelist():
                        text = zf.read(name).decode("utf-8")
                        for i, line in enumerate(_csv_records(text)):
                            out.append((f"{p}!{name}", i, line))
            yield pd.DataFrame(out, columns=["member", "lineno", "line"])

    ls = raw.mapInPandas(lines, "member string, lineno long, line string")
    if schema is None:
        first = ls.where(F.col("lineno") == 0).select("line").first()
        cols = first[0].split(sep) if first else []
        schema = ", ".join(f"`{c}` string" for c in cols)
    body = ls.where(F.col("lineno") > 0) if header else ls
    parsed = body.select(F.from_csv("line", schema, {"sep": sep}).alias("r"))
    return parsed.select("r.*")


def _csv_records(text: str) -> list[str]:
    """Records of a CSV text: lines end at CR, LF or CRLF outside quotes; blank lines are kept, a final line end adds none."""
    records, start, quoted = [], 0, False
    for m in re.finditer(r'"|\r\n|\r|\n', text):
        if m.group() == '"':
            quoted = not quoted
        elif not quoted:
            records.append(text[start : m.start()])
            start = m.end()
    if start < len(text):
        records.append(text[start:])
    return records


def write_csv(df: DataFrame, path: str, header: bool = True, label: str | None = None, sep: str = ",") -> None:
    """CSV sink, optionally label column first, with or without header."""
    if label is not None:
        df = df.select(label, *[c for c in df.columns if c != label])
    df.write.mode("overwrite").option("header", header).option("sep", sep).csv(path)


# ------------------------------------------------------------------ A2, A9

def read_json_corpus(spark: SparkSession, path: str, multiline: bool = True, schema=None) -> DataFrame:
    """A2: a folder of JSON documents (one multi-line object per file) or JSON lines."""
    r = spark.read.option("multiLine", multiline)
    if schema is not None:
        r = r.schema(schema)
    return r.json(path)


def write_json_documents(df: DataFrame, path: str) -> None:
    """A2 helper: one pretty-printed JSON document per row, written by each task to the
    shared folder ``path``.  A file is named by its partition and place there, so a
    retried or speculative task writes the same names again."""
    import json

    cols = df.columns

    def write_part(rows):
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        for i, r in enumerate(rows):
            d = {c: r[c] for c in cols}
            _write_file(path, f"doc-{part:06d}-{i:09d}.json", json.dumps(d, indent=2, ensure_ascii=False, default=str).encode("utf-8"))

    df.foreachPartition(write_part)


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """One row per text line (``value``)."""
    return spark.read.text(path)


def read_parallel(spark: SparkSession, path: str, sep: str = "\t") -> DataFrame:
    """Parallel corpus ``src<TAB>dst`` lines."""
    parts = F.split(F.col("value"), sep, 2)
    return spark.read.text(path).select(parts[0].alias("src"), parts[1].alias("dst"))


# ------------------------------------------------------------------ A5, A8, F8

def read_images(spark: SparkSession, path: str, decode: bool = True) -> DataFrame:
    """A5: image folder.  ``decode``: Spark's image source (height, width, nChannels, BGR bytes);
    otherwise the raw binary files (path, modificationTime, length, content)."""
    if decode:
        return spark.read.format("image").option("dropInvalid", True).load(path)
    return spark.read.format("binaryFile").load(path)


def write_binaries(df: DataFrame, name_col: str, bytes_col: str, out: str, as_files: bool = False) -> None:
    """Write one output per row.  Default: a Parquet table of ``(name, bytes)``; with
    ``as_files`` each task writes its rows as individual files into the shared folder ``out``."""
    if not as_files:
        df.select(F.col(name_col).alias("name"), F.col(bytes_col).alias("bytes")).write.mode("overwrite").parquet(out)
        return

    def write_part(rows):
        for r in rows:
            _write_file(out, os.path.basename(r[name_col]), bytes(r[bytes_col]))

    df.select(name_col, bytes_col).foreachPartition(write_part)


def bmp_bytes(rgb: np.ndarray) -> bytes:
    """Uncompressed 24-bit BMP of an ``H x W x 3`` uint8 RGB array (readable by Spark's image source)."""
    h, w, _ = rgb.shape
    row = (w * 3 + 3) & ~3
    size = 54 + row * h
    header = b"BM" + size.to_bytes(4, "little") + b"\0\0\0\0" + (54).to_bytes(4, "little")
    info = (40).to_bytes(4, "little") + w.to_bytes(4, "little") + h.to_bytes(4, "little") + (1).to_bytes(2, "little")
    info += (24).to_bytes(2, "little") + b"\0" * 4 + (row * h).to_bytes(4, "little") + b"\0" * 16
    body = bytearray()
    for y in range(h - 1, -1, -1):  # bottom-up rows, BGR order
        line = rgb[y, :, ::-1].astype(np.uint8).tobytes()
        body += line + b"\0" * (row - w * 3)
    return header + info + bytes(body)


# ------------------------------------------------------------------ A10

BOOKKEEPING = ("write_time", "api_invocation_time", "is_deleted")


def write_features(df: DataFrame, path: str, key: str = "index", event_time: str | None = None,
                   event_time_value: str | None = None) -> None:
    """A10: append to an offline feature table: record id ``key`` (added as a dense
    position when absent), ISO-8601 ``event_time`` (constant when not given) and the
    store's bookkeeping columns; partitioned by event date."""
    from tessera.operators.ranking import row_position

    out = df if key in df.columns else row_position(df, key)
    if event_time is None:
        ts = event_time_value or "1970-01-01T00:00:00Z"
        out = out.withColumn("event_time", F.lit(ts))
        event_time = "event_time"
    out = (out.withColumn("write_time", F.current_timestamp())
           .withColumn("api_invocation_time", F.current_timestamp())
           .withColumn("is_deleted", F.lit(False))
           .withColumn("event_date", F.substring(F.col(event_time).cast("string"), 1, 10)))
    out.write.mode("append").partitionBy("event_date").parquet(path)


def read_features(spark: SparkSession, path: str, key: str = "index", event_time: str = "event_time",
                  latest: bool = True) -> DataFrame:
    """A10: read the offline table, keep the latest non-deleted record per key
    (``max_by`` over ``(event_time, write_time)``: one partial aggregate) and drop the
    bookkeeping columns."""
    df = spark.read.parquet(path)
    if latest:
        cols = [c for c in df.columns if c != key]
        best = F.max_by(F.struct(*cols), F.struct(F.col(event_time).cast("string"), "write_time"))
        df = df.groupBy(key).agg(best.alias("_r")).select(key, "_r.*")
        df = df.where(~F.col("is_deleted"))
    return df.drop(*BOOKKEEPING, "event_date")


# ------------------------------------------------------------------ A11

def save_model(model, path: str) -> None:
    """Persist a fitted ``PipelineModel`` (overwrite)."""
    model.write().overwrite().save(path)


def load_model(path: str):
    """Load a saved ``PipelineModel``."""
    from pyspark.ml import PipelineModel

    return PipelineModel.load(path)
