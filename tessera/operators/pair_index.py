"""BPE training on an inverted index from pairs to their places.

Units are held as linked symbols with an index ``pair -> places``.  A merge visits
only the places of its pair and returns what that changes in the counts of the
neighbouring pairs, from which the next pair follows.

:func:`learn_alone` runs in one task on the bounded distinct runs of
:mod:`tessera.operators.pair_runs`, which hold every pair of more than ``floor``
occurrences.  A merge of such a pair makes new pairs in these runs only, and can but
lower the counts of old ones; so counts above ``floor`` are exact and the
merges right until none is left above it.

:func:`learn_together` merges pairs whose runs are too many for that: the tasks
of a barrier stage hold a share of the units each, and the changes of the counts
(a few short rows) go to all of them through the barrier's ``allGather``, so all keep
the same table and find the same next pair.  That table starts from the
``tracked`` most frequent pairs, and is exact above ``floor``, the count of the
first that is not in it, for the same reason.  The stage ends with the compacted units in the
shared folder; should an executor be lost, Spark runs it anew from the last
such table.  A barrier needs all its tasks at once, so there are as many as the cluster has cores.
"""

from __future__ import annotations

import base64
import heapq
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tessera.sources.files import scratch_path

#: Merges of one barrier stage.
TOGETHER = 32
#: Pair counts that a barrier stage starts from.
TRACKED = 100_000
#: Places of a pair that no unit of any task has.
NOWHERE = (2**62, 2**62)

SCHEMA = "kind int, seq long, freq long, ids array<int>"


class PairIndex:
    """A task's units as linked symbols, and the places of each pair."""

    def __init__(self) -> None:
        self.symbol, self.after, self.before, self.unit = array("i"), array("i"), array("i"), array("i")
        self.seq, self.freq, self.starts, self.place = array("q"), array("q"), array("i"), array("q")
        self.places: dict[tuple[int, int], list[int]] = {}

    def add(self, seq: int, freq: int, ids: list[int], place: int = 0) -> None:
        """``place``: where the symbols start in the unit ``seq``."""
        start, unit, last = len(self.symbol), len(self.seq), len(ids) - 1
        self.seq.append(seq)
        self.freq.append(freq)
        self.starts.append(start)
        self.place.append(place)
        self.symbol.extend(ids)
        self.unit.extend([unit] * len(ids))
        self.before.extend([-1, *range(start, start + last)])
        self.after.extend([*range(start + 1, start + last + 1), -1])
        for at, pair in enumerate(zip(ids, ids[1:], strict=False), start):
            self.places.setdefault(pair, []).append(at)

    def merge(self, a: int, b: int, new: int) -> dict[tuple[int, int], int]:
        """Merge the pair everywhere, left to right; the changes of all other pairs' counts."""
        symbol, after, before, unit, freq, places = self.symbol, self.after, self.before, self.unit, self.freq, self.places
        change: dict[tuple[int, int], int] = {}
        for at in sorted(places.pop((a, b), ())):
            right = after[at]
            if symbol[at] != a or right < 0 or symbol[right] != b:
                continue  # merged with another neighbour since
            weight = freq[unit[at]]
            left, beyond = before[at], after[right]
            symbol[at], symbol[right] = new, -1
            after[at] = beyond
            if left >= 0:
                x = symbol[left]
                change[x, a] = change.get((x, a), 0) - weight
                change[x, new] = change.get((x, new), 0) + weight
                places.setdefault((x, new), []).append(left)
            if beyond >= 0:
                before[beyond] = at
                y = symbol[beyond]
                change[b, y] = change.get((b, y), 0) - weight
                change[new, y] = change.get((new, y), 0) + weight
                places.setdefault((new, y), []).append(at)
        change.pop((a, b), None)
        return {p: d for p, d in change.items() if d}

    def first(self, pair: tuple[int, int]) -> tuple[int, int]:
        """Unit number and place of the pair's first occurrence here."""
        symbol, after, unit = self.symbol, self.after, self.unit
        live = [at for at in self.places.get(pair, ()) if symbol[at] == pair[0] and after[at] >= 0 and symbol[after[at]] == pair[1]]
        return min(((self.seq[u], self.place[u] + at - self.starts[u]) for at in live for u in (unit[at],)), default=NOWHERE)

    def counts(self) -> dict[tuple[int, int], int]:
        unit, freq = self.unit, self.freq
        return {pair: sum(freq[unit[at]] for at in places) for pair, places in self.places.items()}

    def units(self) -> Iterator[tuple[int, int, list[int]]]:
        """The units of two symbols or more, as they are now."""
        ends = [*self.starts, len(self.symbol)][1:]
        for seq, freq, start, end in zip(self.seq, self.freq, self.starts, ends, strict=True):
            ids = [s for s in self.symbol[start:end] if s >= 0]
            if len(ids) > 1:
                yield seq, freq, ids


class PairCounts:
    """The pair counts, ordered by count (and then by the larger pair)."""

    def __init__(self, counts: dict[tuple[int, int], int]):
        self.counts = counts
        self.queue = [(-n, -a, -b) for (a, b), n in counts.items()]
        heapq.heapify(self.queue)

    def change(self, pair: tuple[int, int], by: int, old_symbols: int) -> None:
        """Pairs of symbols below ``old_symbols`` that are not in the table stay out of it."""
        count = self.counts.get(pair)
        if count is None:
            if max(pair) < old_symbols:
                return
            count = 0
        self.counts[pair] = count = count + by
        if count > 0:
            heapq.heappush(self.queue, (-count, -pair[0], -pair[1]))

    def top(self) -> tuple[tuple[int, int] | None, int]:
        """The first pair and its count; entries of older counts go."""
        while self.queue:
            count, pair = -self.queue[0][0], (-self.queue[0][1], -self.queue[0][2])
            if self.counts[pair] == count:
                return pair, count
            heapq.heappop(self.queue)
        return None, 0

    def take(self, level: int) -> list[tuple[int, int]]:
        """All pairs of the top count ``level``, taken off the queue."""
        found = {}
        while (top := self.top())[1] == level:
            found[top[0]] = None
            heapq.heappop(self.queue)
        return list(found)


def packed(rows: list[tuple[int, ...]], width: int) -> str:
    return base64.b64encode(np.array(rows, "<i8").reshape(-1, width).tobytes()).decode()


def unpacked(message: str, width: int) -> list[list[int]]:
    return np.frombuffer(base64.b64decode(message), "<i8").reshape(-1, width).tolist()


class Turn:
    """The next pair to merge.  ``gather`` exchanges a message with all tasks."""

    def __init__(self, index: PairIndex, pairs: PairCounts, floor: int, by_first: bool, gather):
        self.index, self.pairs, self.floor, self.by_first, self.gather = index, pairs, floor, by_first, gather
        self.level = 0
        self.tied: list[tuple[tuple[int, int], tuple[int, int]]] = []  # (first occurrence, pair) of the pairs with `level` occurrences

    def next(self) -> tuple[int, int] | None:
        pair, count = self.pairs.top()
        if not self.by_first:
            return pair if count > self.floor else None
        # a pair's occurrences, and so its first one, stay the same as long as its count does
        while self.tied and self.pairs.counts[self.tied[0][1]] != self.level:
            heapq.heappop(self.tied)
        if not self.tied:
            self.level = count
        if self.level <= self.floor:
            return None
        if count == self.level:
            fresh = self.pairs.take(count)
            answers = [unpacked(m, 2) for m in self.gather(packed([self.index.first(p) for p in fresh], 2))]
            for k, p in enumerate(fresh):
                heapq.heappush(self.tied, (min(tuple(a[k]) for a in answers), p))
        return heapq.heappop(self.tied)[1]


def learn(index: PairIndex, counts: dict[tuple[int, int], int], floor: int, first_id: int, most: int, by_first: bool, gather) -> list[tuple[int, int, int]]:
    """Up to ``most`` merges; all tasks run this on their own units and come to the same list."""
    pairs, merges = PairCounts(counts), []
    turn = Turn(index, pairs, floor, by_first, gather)
    while len(merges) < most and (pair := turn.next()) is not None:
        new = first_id + len(merges)
        merges.append((*pair, new))
        own = index.merge(*pair, new)
        total: dict[tuple[int, int], int] = {}
        for message in gather(packed([(x, y, d) for (x, y), d in own.items()], 3)):
            for x, y, d in unpacked(message, 3):
                total[x, y] = total.get((x, y), 0) + d
        pairs.counts[pair] = 0
        for p, d in total.items():
            if d:
                pairs.change(p, d, first_id)
    return merges


def _index(batches: Iterator[pa.RecordBatch]) -> PairIndex:
    index = PairIndex()
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            index.add(*row)
    return index


def learn_alone(units: DataFrame, floor: int, first_id: int, most: int, by_first: bool) -> list[tuple[int, int, int]]:
    """Up to ``most`` merges ``(left, right, new)`` of pairs with more than ``floor`` occurrences, from units of a bounded size."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = _index(batches)
        merges = learn(index, index.counts(), floor, first_id, most, by_first, lambda message: [message])
        yield pa.RecordBatch.from_arrays([pa.array([m[k] for m in merges], pa.int32()) for k in range(3)], ["a", "b", "new"])

    columns = [c for c in ("seq", "freq", "ids", "place") if c in units.columns]
    found = units.select(*columns).repartition(1).mapInArrow(run, "a int, b int, new int").collect()
    return sorted((tuple(r) for r in found), key=lambda m: m[2])


def learn_together(units: DataFrame, counts: dict[tuple[int, int], int], floor: int, first_id: int, most: int,
                   by_first: bool) -> tuple[list[tuple[int, int, int]], DataFrame]:
    """Up to ``most`` merges by all tasks, and the units after them."""
    spark = units.sparkSession
    shared = spark.sparkContext.broadcast(counts)  # bounded: the tracked pairs

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import BarrierTaskContext

        task = BarrierTaskContext.get()
        index = _index(batches)
        merges = learn(index, dict(shared.value), floor, first_id, most, by_first, task.allGather)
        if task.partitionId() == 0:
            yield _rows([(1, k, 1, list(m)) for k, m in enumerate(merges)])
        rows = []
        for unit in index.units():
            rows.append((0, *unit))
            if len(rows) == 4096:
                yield _rows(rows)
                rows = []
        yield _rows(rows)

    tasks = spark.sparkContext.defaultParallelism
    learnt = units.select("seq", "freq", "ids").repartition(tasks, "seq").mapInArrow(run, SCHEMA, barrier=True)
    path = scratch_path(spark, "bpe-units")
    learnt.write.parquet(path)
    result = spark.read.schema(SCHEMA).parquet(path)
    merges = sorted((tuple(r["ids"]) for r in result.where("kind = 1").select("ids").collect()), key=lambda m: m[2])  # at most `most`
    return merges, result.where("kind = 0").select("seq", "freq", "ids")


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    kinds = pa.schema([("kind", pa.int32()), ("seq", pa.int64()), ("freq", pa.int64()), ("ids", pa.list_(pa.int32()))])
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], f.type) for k, f in enumerate(kinds)], schema=kinds)
