"""Byte-level BPE encoding and decoding with overlapping chunks.

Texts of at most ``chunk`` characters are pre-tokenised and encoded in one
piece.  Longer ones are cut into chunks that overlap by ``overlap`` characters
on both sides and are spread over the tasks:

1. every chunk is pre-tokenised on its own, wherever its first character falls
   within a pre-token, and reports the pre-token borders near its two ends;
2. neighbouring chunks are stitched at the first border that both report.  The
   splitting pattern looks only ahead, so from a common border on both chunks
   split alike; borders within ``_AHEAD`` characters of a chunk's end, whose
   right context is cut off, are not reported;
3. the pieces between two stitches are encoded (cut out after splitting, since
   the last of them ends where its right context says), and the ids of a
   text's chunks are concatenated in order.

A text in which some pair of neighbours shares no border (one pre-token longer
than the overlap) is put together again and encoded as a whole.  Every
pre-token is merged by the ``tiktoken`` library; the ids of frequent ones are
kept while the process lives, at most ``2 * CACHED``.  Decoding concatenates the raw
bytes of the ids.

Defined results: null and empty texts have no ids; repeated rows are encoded
one by one; strings of special tokens are ordinary text; an empty table gives
an empty result; columns of the input may have any name.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import RecentCache, slices, written
from tessera.llm.files import open_random

CHUNK = 1 << 15
OVERLAP = 1 << 10
_AHEAD = 4  # the pattern's longest fixed look: an apostrophe and two letters, and the character after a run


class PieceCoder:
    """Pre-tokeniser and merges of a rank file; ``piece -> ids`` is kept for frequent pieces."""

    CACHED = 60_000

    def __init__(self, ranks_path: str, pattern: str):
        import regex
        import tiktoken

        with open_random(ranks_path) as f:
            lines = f.read().splitlines()
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines) if token}
        self.pattern = regex.compile(pattern)
        self.encoding = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.bytes_of = {rank: token for token, rank in ranks.items()}
        self.known = RecentCache(self._merge, self.CACHED)

    def encode(self, text: str, size: int | None = None) -> bytes:
        """Ids of a text as little-endian unsigned 32-bit integers, piece by piece.

        With ``size``, a border of the text, only of its first ``size`` characters; the rest is the
        right context in which their pre-tokens end.
        """
        pieces = self.pattern.findall(text)
        beyond = 0 if size is None else len(text) - size
        while beyond > 0:
            beyond -= len(pieces.pop())
        return b"".join(map(self.known.__getitem__, pieces))

    def _merge(self, piece: str) -> bytes:
        return np.array(self.encoding._core_bpe.encode_single_piece(piece.encode("utf-8")), "<u4").tobytes()

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, np.frombuffer(ids, "<u4").tolist()))

    def borders(self, text: str, start: int) -> list[int]:
        """Ends of the pre-tokens of ``text`` whose right context is certain, as places counted from ``start``."""
        most = len(text) - _AHEAD
        return [start + m.end() for m in self.pattern.finditer(text) if m.end() <= most]


_CODERS: dict[tuple[str, str], PieceCoder] = {}


def coder(ranks_path: str, pattern: str) -> PieceCoder:
    """The process's coder for a rank file and pattern."""
    key = ranks_path, pattern
    if key not in _CODERS:
        _CODERS[key] = PieceCoder(*key)
    return _CODERS[key]


def _decimal(ids: bytes) -> bytes:
    return ",".join(map(str, np.frombuffer(ids, "<u4").tolist())).encode()


_ENCODED = "ids binary"


def _short(rows: DataFrame, kind: str, ranks_path: str, pattern: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            own = coder(ranks_path, pattern)
            ids, last = [], None
            for t in part.column(1).to_pylist():
                # copies that follow each other (of a mixture) are encoded once
                ids.append(ids[-1] if ids and t == last else own.encode(t or ""))
                last = t
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(ids, pa.binary())], names=["_id", "ids"])

    return rows.mapInArrow(run, f"_id {kind}, {_ENCODED}")


def _long(rows: DataFrame, kind: str, ranks_path: str, pattern: str, chunk: int, overlap: int) -> DataFrame:
    if chunk <= 2 * overlap + _AHEAD:
        raise ValueError("a chunk must be longer than its two overlaps")

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task, row = TaskContext.get().partitionId(), 0
        for batch in batches:
            for i in range(batch.num_rows):
                text = batch.column(1)[i].as_py()
                starts = list(range(0, len(text), chunk))
                lows = [max(0, s - overlap) for s in starts]
                parts = [text[a : s + chunk + overlap] for a, s in zip(lows, starts, strict=True)]
                uid = (task << 40) + row
                row += 1
                for k in range(0, len(parts), 16):
                    n = len(parts[k : k + 16])
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([uid] * n, pa.int64()), batch.column(0).take(pa.array([i] * n)), pa.array(range(k, k + n), pa.int64()),
                         pa.array([len(text)] * n, pa.int64()), pa.array(lows[k : k + 16], pa.int64()), pa.array(parts[k : k + 16], pa.string())],
                        names=["uid", "_id", "c", "size", "low", "part"],
                    )

    def pretokenise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 32):
            own = coder(ranks_path, pattern)
            heads, tails = [], []
            for c, low, part in zip(*(batch.column(x).to_pylist() for x in ("c", "low", "part")), strict=True):
                found = own.borders(part, low)
                heads.append([p for p in found if p <= c * chunk + overlap])
                tails.append([p for p in found if p >= (c + 1) * chunk - overlap])
            places = pa.list_(pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("uid"), batch.column("c"), pa.array(heads, places), pa.array(tails, places)],
                names=["uid", "c", "heads", "tails"],
            )

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 32):
            own = coder(ranks_path, pattern)
            out = []
            names = ("c", "low", "part", "whole", "begin", "end")
            for c, low, part, whole, begin, end in zip(*(batch.column(x).to_pylist() for x in names), strict=True):
                if whole:  # no common border somewhere in this text: hand the bare chunk on
                    out.append(part[c * chunk - low : (c + 1) * chunk - low].encode("utf-8"))
                else:
                    out.append(own.encode(part[begin - low :], None if end is None else end - begin))
            yield pa.RecordBatch.from_arrays(
                [batch.column(x) for x in ("uid", "_id", "c", "whole")] + [pa.array(out, pa.binary())],
                names=["uid", "_id", "c", "whole", "data"],
            )

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = coder(ranks_path, pattern)
        key, ident, whole, parts = None, None, False, []

        def closed() -> pa.RecordBatch:
            data = b"".join(parts)
            return pa.RecordBatch.from_arrays(
                [pa.concat_arrays([ident]), pa.array([own.encode(data.decode("utf-8")) if whole else data], pa.binary())],
                names=["_id", "ids"],
            )

        for batch in batches:
            for i in range(batch.num_rows):
                uid = batch.column(0)[i].as_py()
                if uid != key:
                    if key is not None:
                        yield closed()
                    key, ident, whole, parts = uid, batch.column(1).slice(i, 1), batch.column(3)[i].as_py(), []
                parts.append(batch.column(4)[i].as_py())
        if key is not None:
            yield closed()

    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    chunks = written(rows.mapInArrow(split, f"uid long, _id {kind}, c long, size long, low long, part string"), "chunks")
    spread = chunks.repartition(n, "uid", "c")
    borders = written(spread.mapInArrow(pretokenise, "uid long, c long, heads array<long>, tails array<long>"), "borders")
    left = borders.select("uid", (F.col("c") + 1).alias("c"), "tails")
    # the lists of places are far smaller as Parquet than in the driver: not broadcast
    seams = borders.select("uid", "c", "heads").join(left.hint("merge"), ["uid", "c"]).select("uid", "c", F.array_min(F.array_intersect("tails", "heads")).alias("begin"))
    torn = seams.groupBy("uid").agg(F.max(F.col("begin").isNull()).alias("whole"))
    ends = seams.select("uid", (F.col("c") - 1).alias("c"), F.col("begin").alias("end"))
    placed = (
        chunks.join(seams, ["uid", "c"], "left").join(ends, ["uid", "c"], "left").join(torn, "uid", "left")
        .select("uid", "_id", "c", "low", "part", F.coalesce("whole", F.lit(False)).alias("whole"),
                F.coalesce("begin", F.lit(0).cast("long")).alias("begin"), "end")
    )
    coded = placed.mapInArrow(encode, f"uid long, _id {kind}, c long, whole boolean, data binary")
    return coded.repartition(n, "uid").sortWithinPartitions("uid", "c").mapInArrow(join, f"_id {kind}, {_ENCODED}")


def encode(
    docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text",
    chunk: int = CHUNK, overlap: int = OVERLAP,
) -> DataFrame:
    """One row per input row: id and ``ids``, the token ids as little-endian unsigned 32-bit integers."""
    slim = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    kind = slim.schema["_id"].dataType.simpleString()
    size = F.coalesce(F.char_length("_text"), F.lit(0))
    short = _short(slim.where(size <= chunk), kind, ranks_path, pattern)
    long = _long(slim.where(size > chunk), kind, ranks_path, pattern, chunk, overlap)
    return short.union(long).withColumnRenamed("_id", id_col)


def decode(encoded: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", digests: bool = False) -> DataFrame:
    """``encoded`` with its bytes restored: id and ``data``; with ``digests`` the counts and digests instead.

    Digests: ``n_tokens``, ``ids_sha256`` (decimal ids joined by commas) and ``decoded_sha256`` (the bytes).
    """
    kind = encoded.schema[id_col].dataType.simpleString()
    out = "n_tokens long, ids_sha256 string, decoded_sha256 string" if digests else "data binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            own = coder(ranks_path, pattern)
            found = part.column(1).to_pylist()
            data = [own.decode(ids) for ids in found]
            if digests:
                cols = [pa.array([len(ids) // 4 for ids in found], pa.int64()),
                        pa.array([hashlib.sha256(_decimal(ids)).hexdigest() for ids in found], pa.string()),
                        pa.array([hashlib.sha256(x).hexdigest() for x in data], pa.string())]
            else:
                cols = [pa.array(data, pa.binary())]
            yield pa.RecordBatch.from_arrays([part.column(0), *cols], names=["_id", *[x.split()[0] for x in out.split(", ")]])

    return encoded.select(id_col, "ids").mapInArrow(run, f"_id {kind}, {out}").withColumnRenamed("_id", id_col)
