"""Substring dedup: seed and extend on winnowed anchors.

A repeat is a run of at least ``window`` words of a document that also occurs
in a document with a smaller id; the words of all such runs are removed.

*Seeds.*  Word ``GRAM``-grams are hashed by a rolling polynomial and winnowed:
of the grams inside each window of ``window`` words the one with the smallest
hash (the rightmost on ties) is its anchor.  The choice depends on the words
of the window alone, so equal windows carry the same anchor at the same place,
and one anchor serves a run of consecutive windows.

*Extension.*  Each anchor is extended both ways over the windows it serves: the
words from the first of them to the end of the last are its context.  Anchors
are joined by gram hash.  Occurrences with the same context match over their
whole length, so the smallest document owns the context and the others lose it
- copies cost one row each, never a pair.  Only where one anchor has several
contexts do the owners publish the extensions one by one (one 64-bit key per
window start, relative to the anchor); the smallest document per key owns it.
Overlapping and touching matches are merged into maximal repeats.

Every step is a map-side combined minimum plus a join on the key, so an anchor,
passage or text held by a third of all rows is neither gathered in one group
nor multiplied out.

Hashes: contexts and extensions are compared by two independent 64-bit values
(gram hash and polynomial of the words) of 64-bit word hashes.

Defined results: null and empty texts have no word and keep nothing; texts
shorter than a window are kept whole; a null id neither owns nor loses words;
rows repeated with one id and text get the same result each, rows that share
an id but not the text are told apart by a hash of the text and never remove
each other's words.  An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import slices, written

WINDOW = 50  # fixed value of the contract
GRAM = 10

_BASE = 0xD6E8FEB86659FD93  # odd, hence invertible modulo 2**64
_INVERSE = pow(_BASE, -1, 1 << 64)
_PLACE_BITS = 20
_BLOCK = (1 << _PLACE_BITS) - 4096  # grams winnowed at a time; places within a block fit the low bits


class _Words:
    """The words of one text with prefix sums for hashes of any run of words."""

    def __init__(self, text: bytes):
        self.words = text.split()
        n = len(self.words)
        digest = xxhash.xxh64_intdigest
        hashed = np.fromiter(map(digest, self.words), np.uint64, n)
        power = np.full(n + 1, _BASE, np.uint64)
        power[0] = 1
        back = np.full(n + 1, _INVERSE, np.uint64)
        back[0] = 1
        self.back = np.multiply.accumulate(back)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(hashed * np.multiply.accumulate(power)[:n], out=self.sums[1:])

    def __len__(self) -> int:
        return len(self.words)

    def runs(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Hash of the words ``[start, end)`` for each pair, independent of where they stand."""
        return _mix((self.sums[ends] - self.sums[starts]) * self.back[starts])


def _mix(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0x9FB21C651E98DF25)
    return h ^ (h >> np.uint64(29))


def _sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` consecutive values, by doubling."""
    out, have = x, 1
    while 2 * have <= width:
        out = np.minimum(out[:-have], out[have:])
        have *= 2
    if have < width:
        out = np.minimum(out[: len(x) - width + 1], out[width - have : width - have + len(x) - width + 1])
    return out


def anchors(words: _Words, window: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``(gram hash, gram place, first window start, last window start)`` of every anchor of a text."""
    empty = np.empty(0, np.int64)
    n = len(words)
    if n < window:
        return empty.astype(np.uint64), empty, empty, empty
    at = np.arange(n - gram + 1)
    grams = words.runs(at, at + gram)
    width = window - gram + 1
    places = []
    low = np.uint64((1 << _PLACE_BITS) - 1)
    for k in range(0, n - window + 1, _BLOCK):
        part = grams[k : k + _BLOCK + width - 1]
        tag = low - np.arange(len(part), dtype=np.uint64)  # a later place wins a tie
        best = _sliding_min((part & ~low) | tag, width)
        places.append((low - (best & low)).astype(np.int64) + k)
    chosen = np.concatenate(places)
    cut = np.flatnonzero(np.diff(chosen)) + 1
    first = np.concatenate(([0], cut))
    last = np.concatenate((cut - 1, [len(chosen) - 1]))
    place = chosen[first]
    return grams[place], place, first, last


def _keys(words: _Words, place: np.ndarray, first: np.ndarray, last: np.ndarray, window: int) -> np.ndarray:
    """Context key: the words from the first window's start to the last one's end, and where the anchor stands."""
    shape = ((place - first) * 4096 + (last - first)).astype(np.uint64)
    return _mix(words.runs(first, last + window) + shape * np.uint64(_BASE))


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64), pa.int64())


def _seed_rows(docs: DataFrame, kind: str, window: int, gram: int) -> DataFrame:
    """One row per anchor: ``h, ctx, doc, tag, first, last``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            found, rows = [], []
            for i, text in enumerate(part.column(2).to_pylist()):
                words = _Words(text or b"")
                h, place, first, last = anchors(words, window, gram)
                if len(h):
                    found.append((h, _keys(words, place, first, last, window), first, last))
                    rows.append(np.full(len(h), i))
            if not found:
                continue
            h, ctx, first, last = (np.concatenate(x) for x in zip(*found, strict=True))
            row = pa.array(np.concatenate(rows))
            yield pa.RecordBatch.from_arrays(
                [_signed(h), _signed(ctx), part.column(0).take(row), part.column(1).take(row),
                 pa.array(first.astype(np.int32)), pa.array(last.astype(np.int32))],
                names=["h", "ctx", "doc", "tag", "first", "last"],
            )

    return docs.mapInArrow(run, f"h long, ctx long, doc {kind}, tag long, first int, last int")


def _extension_rows(texts: DataFrame, kind: str, window: int, gram: int) -> DataFrame:
    """``texts``: ``doc, tag, text, wanted`` (starts of the first windows of the anchors to extend).

    One row per window start of these anchors: ``h, ext, doc, tag, first``; ``ext`` is the key of the
    extension, the words of the window and where the anchor stands in it.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, 64):
            found, rows = [], []
            for i, (text, wanted) in enumerate(zip(part.column(2).to_pylist(), part.column(3).to_pylist(), strict=True)):
                words = _Words(text or b"")
                h, place, first, last = anchors(words, window, gram)
                pick = np.isin(first, np.array(wanted, np.int64))
                h, place, first, last = h[pick], place[pick], first[pick], last[pick]
                times = last - first + 1
                which = np.repeat(np.arange(len(h)), times)
                start = first[which] + np.arange(len(which)) - np.repeat(np.cumsum(times) - times, times)
                shape = (place[which] - start).astype(np.uint64)
                ext = _mix(words.runs(start, start + window) + shape * np.uint64(_BASE))
                found.append((h[which], ext, start))
                rows.append(np.full(len(which), i))
            if not found:
                continue
            h, ext, start = (np.concatenate(x) for x in zip(*found, strict=True))
            row = pa.array(np.concatenate(rows))
            yield pa.RecordBatch.from_arrays(
                [_signed(h), _signed(ext), part.column(0).take(row), part.column(1).take(row), pa.array(start.astype(np.int32))],
                names=["h", "ext", "doc", "tag", "first"],
            )

    return texts.mapInArrow(run, f"h long, ext long, doc {kind}, tag long, first int")


def _tagged(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``doc, tag, text``: the tag tells rows apart that share an id but not the text."""
    text = F.col(text_col)
    return docs.select(F.col(id_col).alias("doc"), F.xxhash64(text).alias("tag"), text.cast("binary").alias("text"))


def repeats(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, gram: int = GRAM
) -> DataFrame:
    """Removable runs: ``doc, tag, spans`` with ``spans`` the matched word ranges ``(first, last window start)``."""
    if not 0 < gram < window <= 4096:
        raise ValueError("0 < gram < window <= 4096")
    rows = _tagged(docs, id_col, text_col)
    kind = rows.schema["doc"].dataType.simpleString()
    known = rows.where(F.col("doc").isNotNull())
    seeds = written(_seed_rows(known, kind, window, gram), "anchors")
    # Owner of every context, and how many contexts each anchor has.
    contexts = written(
        seeds.groupBy("h", "ctx").agg(F.min("doc").alias("owner"), F.count("*").alias("n")), "contexts"
    )
    several = contexts.groupBy("h").agg(F.count("*").alias("forms")).where("forms > 1").select("h")
    shared = contexts.where("n > 1").select("h", "ctx", "owner")
    copied = seeds.join(shared, ["h", "ctx"]).where("doc > owner").select("doc", "tag", "first", "last")
    # Owners of one of several contexts of an anchor extend window by window.
    mixed = contexts.join(several, "h").select("h", "ctx", "owner")
    leaders = seeds.join(mixed, ["h", "ctx"]).where("doc = owner").groupBy("doc", "tag").agg(F.collect_set("first").alias("wanted"))
    asked = rows.join(leaders, ["doc", "tag"]).select("doc", "tag", "text", "wanted")
    extended = written(_extension_rows(asked, kind, window, gram), "extensions")
    firsts = extended.groupBy("h", "ext").agg(F.min("doc").alias("owner"), F.count("*").alias("n")).where("n > 1")
    partial = extended.join(firsts, ["h", "ext"]).where("doc > owner").select("doc", "tag", "first", F.col("first").alias("last"))
    return copied.union(partial).groupBy("doc", "tag").agg(F.collect_list(F.struct("first", "last")).alias("spans"))


def _kept(text: bytes, spans: list, window: int) -> tuple[list[bytes], np.ndarray]:
    """The words of a text and the mask of those inside no span."""
    words = text.split()
    edge = np.zeros(len(words) + 1, np.int64)
    if spans:
        at = np.array([(s["first"], s["last"] + window) for s in spans], np.int64)
        np.add.at(edge, at[:, 0], 1)
        np.add.at(edge, at[:, 1], -1)
    return words, np.cumsum(edge[:-1]) == 0


def remove(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, gram: int = GRAM
) -> DataFrame:
    """One row per input row: id, ``n_words, n_removed, kept_sha256`` and the maximal ``repeats`` (word ranges)."""
    rows = _tagged(docs, id_col, text_col)
    kind = rows.schema["doc"].dataType.simpleString()
    found = repeats(docs, id_col, text_col, window, gram)
    joined = rows.join(found, ["doc", "tag"], "left").select("doc", "text", "spans")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            total, removed, digests, ranges = [], [], [], []
            for text, spans in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                words, keep = _kept(text or b"", spans or [], window)
                step = np.flatnonzero(np.diff(np.concatenate(([True], keep, [True])).astype(np.int8)))
                total.append(len(words))
                removed.append(int(len(words) - keep.sum()))
                if removed[-1]:
                    words = [words[i] for i in np.flatnonzero(keep).tolist()]
                digests.append(hashlib.sha256(b" ".join(words)).hexdigest())
                ranges.append([{"first": a, "end": b} for a, b in step.reshape(-1, 2).tolist()])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(total, pa.int64()), pa.array(removed, pa.int64()), pa.array(digests, pa.string()),
                 pa.array(ranges, pa.list_(pa.struct([("first", pa.int64()), ("end", pa.int64())])))],
                names=["doc", "n_words", "n_removed", "kept_sha256", "repeats"],
            )

    return joined.mapInArrow(
        run, f"doc {kind}, n_words long, n_removed long, kept_sha256 string, repeats array<struct<first:long,end:long>>"
    ).withColumnRenamed("doc", id_col)
