"""Sharding: minimax contiguous partition of ordered atomic groups.

Rows with equal text form an atomic group; groups are ordered by their
smallest id and never split.  The ``shards`` contiguous runs of groups with
the smallest possible largest byte size are found by binary search over the
capacity, each capacity checked greedily (every shard takes groups until the
next would exceed it), and the table is cut where the greedy check of the
smallest feasible capacity cuts.

One range sort of slim rows (no text) gives every row its running byte and row
count; a group is then known by the running total at its end.  The search needs
only "the last group end at or before x".  The driver holds at most
``CELLS`` cells of the total line, each with the first and last group end in
it; a capacity is bracketed by a pessimistic and an optimistic greedy check on
the cells, and only the cells in which the bracket's cuts may lie are refined,
by one aggregate each round, until every cut is exact.  The bound is fixed,
whatever the number of groups.

Defined results: a null text has size 1 and groups with the empty text; a null
id sorts first; repeated rows get slots of their own; an empty table gives an
empty result; shards beyond the number of groups stay empty.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import ranged, running_totals, written

CELLS = 1 << 16


class _Ends:
    """Group ends on the total line, known up to cells ``[first end, last end, count]``."""

    def __init__(self, ends: DataFrame, total: int):
        self.ends, self.total = ends, total
        self.first = self.last = self.count = np.empty(0, np.int64)
        self._refine([(0, total)])

    def _refine(self, ranges: list[tuple[int, int]]) -> None:
        """Replace the cells inside the inclusive ranges by smaller ones."""
        widths = []
        for lo, hi in ranges:
            open_ = (self.count > 2) & (self.first >= lo) & (self.last <= hi)
            half = int((self.last - self.first)[open_].max()) // 2 if open_.any() else hi - lo + 1
            widths.append(max(1, min(half, -(-(hi - lo + 1) * len(ranges) // CELLS))))
        end = F.col("end")
        cell = F.coalesce(*[
            F.when(end.between(lo, hi), F.struct(F.lit(k).alias("range"), F.floor((end - lo) / w).alias("cell")))
            for k, ((lo, hi), w) in enumerate(zip(ranges, widths, strict=True))
        ])
        rows = (
            self.ends.select("end", cell.alias("at")).where("at is not null")
            .groupBy("at").agg(F.min("end").alias("first"), F.max("end").alias("last"), F.count("*").alias("n"))
            .select("first", "last", "n").collect()
        )
        found = np.array([tuple(r) for r in rows], np.int64).reshape(-1, 3)
        keep = np.ones(len(self.first), bool)
        for lo, hi in ranges:
            keep &= (self.last < lo) | (self.first > hi)
        cells = np.concatenate((np.stack((self.first, self.last, self.count), 1)[keep], found))
        cells = cells[np.argsort(cells[:, 0])]
        self.first, self.last, self.count = (np.ascontiguousarray(c) for c in cells.T)

    def before(self, x: int) -> tuple[int, int, int]:
        """Bounds of the last group end at or before ``x``, and the cell to refine (-1: exact)."""
        i = int(np.searchsorted(self.first, x, "right")) - 1
        if i < 0:
            return 0, 0, -1
        if x >= self.last[i]:
            return int(self.last[i]), int(self.last[i]), -1
        if self.count[i] <= 2:
            return int(self.first[i]), int(self.first[i]), -1
        return int(self.first[i]), x, i

    def greedy(self, capacity: int, shards: int, optimistic: bool) -> tuple[bool, list[int]]:
        """Whether ``shards`` runs of at most ``capacity`` reach the total, and where they end."""
        at, cuts = 0, []
        for _ in range(shards):
            low, high, _ = self.before(at + capacity)
            step = high if optimistic else low
            if step <= at:
                return False, cuts
            at = step
            cuts.append(at)
            if at >= self.total:
                return True, cuts
        return False, cuts

    def smallest(self, shards: int, optimistic: bool) -> int:
        low, high = -(-self.total // shards) - 1, self.total  # low is infeasible, high feasible
        while high - low > 1:
            mid = (low + high) // 2
            if self.greedy(mid, shards, optimistic)[0]:
                high = mid
            else:
                low = mid
        return high

    def cuts(self, shards: int) -> tuple[int, list[int]]:
        """The smallest feasible capacity and the ends of its greedy shards."""
        while True:
            least, most = self.smallest(shards, True), self.smallest(shards, False)
            far = self.greedy(most, shards, True)[1]
            near = self.greedy(least, shards, False)[1]
            ranges: list[tuple[int, int]] = []
            at_low = at_high = 0
            for k in range(shards):  # the k-th cut lies between the last ends before these two points
                a, b = at_low + least, at_high + most
                i = max(0, int(np.searchsorted(self.first, a, "right")) - 1)
                j = int(np.searchsorted(self.first, b, "right"))
                hit = i + np.flatnonzero((self.count[i:j] > 2) & (self.last[i:j] > a))
                if len(hit):
                    lo, hi = int(self.first[hit[0]]), int(self.last[hit[-1]])
                    if ranges and lo <= ranges[-1][1]:
                        ranges[-1] = (ranges[-1][0], max(hi, ranges[-1][1]))
                    else:
                        ranges.append((lo, hi))
                at_high = far[k] if k < len(far) else self.total
                at_low = near[k] if k < len(near) else at_low
                if at_low >= self.total:
                    break
            exact = self.greedy(most, shards, False)
            if least == most and exact[1] == self.greedy(most, shards, True)[1]:
                return most, exact[1]
            if not ranges:
                raise AssertionError("a bracket without a cell to refine")
            self._refine(ranges)


def assign(docs: DataFrame, shards: int = 16, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, ``size, text_crc32, law, shard, slot, grown_shard`` and the group's ``first_id``."""
    text = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    rows = written(
        docs.select(F.col(id_col).alias("_id"), (F.octet_length(text) + 1).cast("long").alias("size"),
                    F.crc32(text).alias("text_crc32"), F.unhex(F.sha2(text, 256)).alias("digest")),
        "sizes",
    )
    groups = rows.groupBy("digest").agg(F.min("_id").alias("first_id"))
    keyed = rows.join(groups, "digest").select("first_id", "digest", "_id", "size", "text_crc32")
    line = written(running_totals(ranged(keyed, ["first_id", "digest", "_id"]), {"row": "1", "start": "size"}), "line")
    ends = written(line.groupBy("digest").agg(F.max(F.col("start") + F.col("size")).alias("end")).select("end"), "ends")
    total = line.agg(F.sum("size")).first()[0] or 0
    cuts = _Ends(ends, total).cuts(shards)[1] if total else []
    inner = cuts[:-1]
    shard = F.lit(0)
    for c in inner:
        shard = shard + F.when(F.col("start") >= c, 1).otherwise(0)
    placed = line.withColumn("shard", shard.cast("int"))
    firsts = {r[0]: r[1] for r in placed.groupBy("shard").agg(F.min("row")).collect()}  # one row per shard
    first = F.coalesce(*[F.when(F.col("shard") == s, F.lit(n).cast("long")) for s, n in firsts.items()], F.lit(0).cast("long"))
    return placed.select(
        F.col("_id").alias(id_col), "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
        (F.col("row") - first).alias("slot"), F.lit(None).cast("int").alias("grown_shard"), "first_id",
    )
