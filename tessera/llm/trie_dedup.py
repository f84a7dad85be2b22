"""Exact dedup: Patricia-trie owners.

Two rows are copies when their texts are equal after deleting ASCII white
space.  Every map task inserts the normalised byte strings of its rows into a
compressed radix trie whose terminal nodes hold the best row seen (most code
points in the original text, then the smallest id) and the number of rows.
When the trie outgrows its budget the heaviest subtree is handed downstream
and freed, so a task's memory is bounded whatever the input.  The entries are
partitioned by (length, content hash) of the normalised string and sorted, and
each partition's trie merges the entries of different tasks: equal strings meet
in one terminal node, different strings with the same hash in different ones.
It spills by subtree too: once a key's rows are through, its strings are final.

A text held by a third of all rows reaches the second step as one entry per
map task (or spill), never as its rows.

Defined results: null text counts as empty; empty and all-white texts are one
group; ties are settled by the smallest id, a null id last; rows repeated with
the same id and text are one document: :func:`assign` marks all of them kept,
:func:`dedup` returns one of them.  An empty table gives an empty result.
Columns of the input may have any name.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import slices

WHITE = b" \t\n\x0b\x0c\r"  # fixed value of the contract
_WHITE_SQL = " \t\n\x0b\x0c\r"

#: Bytes that one task's trie may hold, keys and carried texts, before it spills a subtree.
TRIE_BYTES = 24 << 20


class _Node:
    """A trie node: the bytes on the edge to it, its children by first byte, and the entry that ends here."""

    __slots__ = ("edge", "children", "entry")

    def __init__(self, edge: bytes):
        self.edge, self.children, self.entry = edge, {}, None


def _common(a: bytes, b: bytes) -> int:
    """Length of the common prefix, by halving."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    low, high = 0, n  # a[:low] == b[:low], a[:high] != b[:high]
    while high - low > 1:
        mid = (low + high) // 2
        if a[low:mid] == b[low:mid]:
            low = mid
        else:
            high = mid
    return low


class PatriciaTrie:
    """Compressed radix trie over byte strings with one entry ``[rank, count, row, size]`` per terminal node.

    ``rank`` orders the rows of equal strings; the smallest stays.  ``size`` is the
    memory that ``row`` takes.
    """

    def __init__(self, budget: int = TRIE_BYTES):
        self.root, self.held, self.budget = _Node(b""), 0, budget

    def insert(self, key: bytes, rank: tuple, count: int, row, size: int = 0) -> None:
        node, rest = self.root, key
        while rest:
            child = node.children.get(rest[0])
            if child is None:
                child = _Node(rest)
                node.children[rest[0]] = child
                self.held += len(rest) + 200
                node, rest = child, b""
                break
            n = _common(child.edge, rest)
            if n < len(child.edge):  # split the edge
                upper = _Node(child.edge[:n])
                child.edge = child.edge[n:]
                upper.children[child.edge[0]] = child
                node.children[rest[0]] = upper
                self.held += 200
                child = upper
            node, rest = child, rest[n:]
        if node.entry is None:
            node.entry = [rank, count, row, size]
            self.held += 200 + size
        else:
            node.entry[1] += count
            if rank < node.entry[0]:
                self.held += size - node.entry[3]
                node.entry[0], node.entry[2], node.entry[3] = rank, row, size

    def _walk(self, node: _Node, prefix: bytes) -> Iterator[tuple[bytes, list]]:
        stack = [(node, prefix)]
        while stack:
            at, path = stack.pop()
            path += at.edge
            if at.entry is not None:
                yield path, at.entry
            stack.extend((c, path) for c in at.children.values())

    def items(self) -> Iterator[tuple[bytes, list]]:
        return self._walk(self.root, b"")

    def _bytes(self, node: _Node) -> int:
        total, stack = 0, [node]
        while stack:
            at = stack.pop()
            total += len(at.edge) + 200 + (200 + at.entry[3] if at.entry else 0)
            stack.extend(at.children.values())
        return total

    def spill(self) -> Iterator[tuple[bytes, list]]:
        """While the trie is over its budget, hand out and free the heaviest subtree below the root."""
        if self.held <= self.budget:
            return
        weights = sorted(((self._bytes(c), k) for k, c in self.root.children.items()), reverse=True)
        for weight, k in weights:
            if self.held <= self.budget // 2:
                return
            yield from self._walk(self.root.children.pop(k), b"")
            self.held -= weight


def _rank(chars: int, ident) -> tuple:
    return (-chars, ident is None, ident if ident is not None else 0)


def _normalised(text: bytes) -> bytes:
    return text.translate(None, WHITE)


def _rows_by(column_names: list[str], rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    cols = list(zip(*rows, strict=True)) if rows else [()] * len(column_names)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, schema, strict=True)], schema=schema)


def _owners(keyed: DataFrame, budget: int) -> DataFrame:
    """``keyed``: ``_id, _text`` and whatever struct ``_row`` is to be carried.

    Returns one row per distinct normalised text: ``_len, _hash, _text`` (the owner's
    original text), ``_id`` (the owner's id), ``_n`` and ``_row``.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    spark = keyed.sparkSession
    slim = keyed.select("_id", F.col("_text").cast("binary").alias("_text"), "_row")
    combined = slim.select(F.lit(0).alias("_len"), F.lit(0).cast("long").alias("_hash"), "_text", "_id",
                           F.lit(0).cast("long").alias("_n"), "_row").schema
    arrow = to_arrow_schema(combined)

    def entry(key: bytes, found: list) -> tuple:
        text, ident, row = found[2]
        return len(key), xxhash.xxh64_intdigest(key) - (1 << 63), text, ident, found[1], row

    def batches_of(entries: Iterator[tuple]) -> Iterator[pa.RecordBatch]:
        rows, held = [], 0
        for e in entries:
            rows.append(e)
            held += len(e[2]) + 100
            if held > 4 << 20:
                yield _rows_by(combined.names, rows, arrow)
                rows, held = [], 0
        if rows:
            yield _rows_by(combined.names, rows, arrow)

    def combine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def entries() -> Iterator[tuple]:
            trie = PatriciaTrie(budget)
            for part in slices(batches):
                for ident, text, row in zip(*(c.to_pylist() for c in part.columns), strict=True):
                    data = text or b""
                    chars = len(data) if data.isascii() else len(data.decode("utf-8"))
                    trie.insert(_normalised(data), _rank(chars, ident), 1, (data, ident, row), len(data))
                yield from (entry(*x) for x in trie.spill())
            yield from (entry(*x) for x in trie.items())

        yield from batches_of(entries())

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def entries() -> Iterator[tuple]:
            trie, key = PatriciaTrie(budget), None
            for part in slices(batches):
                for size, digest, data, ident, count, row in zip(*(c.to_pylist() for c in part.columns), strict=True):
                    if (size, digest) != key:
                        # the rows come by key, so all strings of earlier keys are complete and may go
                        yield from (entry(*x) for x in trie.spill())
                        key = size, digest
                    chars = len(data) if data.isascii() else len(data.decode("utf-8"))
                    trie.insert(_normalised(data), _rank(chars, ident), count, (data, ident, row), len(data))
            yield from (entry(*x) for x in trie.items())

        yield from batches_of(entries())

    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    local = slim.mapInArrow(combine, combined)
    dealt = local.repartition(parts, "_len", "_hash").sortWithinPartitions("_len", "_hash")
    return dealt.mapInArrow(merge, combined)


def owners(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", budget: int = TRIE_BYTES) -> DataFrame:
    """One row per distinct normalised text: ``text_sha256, keep_id, group_size``."""
    keyed = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"), F.lit(0).cast("byte").alias("_row"))
    found = _owners(keyed, budget)
    return found.select(_digest(F.col("_text").cast("string")).alias("text_sha256"), F.col("_id").alias("keep_id"),
                        F.col("_n").alias("group_size"))


def _digest(text):
    """SHA-256 of the normalised text, JVM-side."""
    return F.sha2(F.translate(F.coalesce(text, F.lit("")), _WHITE_SQL, "").cast("binary"), 256)


def assign(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", budget: int = TRIE_BYTES) -> DataFrame:
    """One row per input row: id, ``keep_id, group_size, kept, text_sha256``.

    The rows meet their group by the digest of the normalised text; only ids
    and digests are shuffled for that, and a hot digest is an ordinary skewed
    join that adaptive execution splits.
    """
    rows = docs.select(F.col(id_col).alias("_id"), _digest(F.col(text_col)).alias("text_sha256"))
    joined = rows.join(owners(docs, id_col, text_col, budget), "text_sha256")
    return joined.select(
        F.col("_id").alias(id_col), "keep_id", "group_size", F.col("_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256"
    )


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", budget: int = TRIE_BYTES) -> DataFrame:
    """The owning row of every group with all its columns (one shuffle: the rows travel inside the entries)."""
    others = [c for c in docs.columns if c not in (id_col, text_col)]
    row = F.struct(F.col(text_col).isNull().alias("_none"), *[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(others)])
    keyed = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"), row.alias("_row"))
    found = _owners(keyed, budget)
    back = {id_col: F.col("_id"), text_col: F.when(~F.col("_row._none"), F.col("_text").cast("string"))}
    back |= {c: F.col(f"_row.c{i}") for i, c in enumerate(others)}
    return found.select(*[back[c].alias(c) for c in docs.columns])
