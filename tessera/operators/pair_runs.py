"""BPE training on the distinct runs of frequent pairs.

A merge can but lower the counts of old pairs, and a new pair is at most as frequent
as the old ones at its place.  So between two neighbours whose pair is found ``floor`` times
or less there is no merge of a pair found more often, whatever is merged around
them, and all units may be cut there.  What is left are runs of *hot* pairs (more than
``floor`` times).  They are short and repeat a lot; the distinct ones, with their counts
and first places, decide every merge above ``floor``, with the same counts as the whole units.

:func:`cut` finds the distinct runs, on units or, for a higher floor, on
runs.  :func:`merged` applies the merges that were learnt, once per distinct run of
a slice, and counts the pairs that follow.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.operators.pair_index import SCHEMA
from tessera.session import remove_now
from tessera.sources.files import scratch_path

#: Symbols that a task works on at a time.
SLICE = 1_000_000
#: Pairs or merged runs that a task holds before it adds them up or forgets them.
HELD = 1_000_000

NAMES = ["kind", "seq", "freq", "ids"]
RUNS = "seq long, place long, freq long, ids array<int>"


def join_pieces(symbols: list[int], table: dict[tuple[int, int], tuple[int, int]]) -> list[int]:
    """Merge a sequence by ``table`` (``pair -> (rank, merged symbol)``), lowest rank first, left to right."""
    value = list(symbols)
    right = list(range(1, len(value))) + [-1]
    left = list(range(-1, len(value) - 1))
    queue = [(table[p][0], at, p) for at, p in enumerate(zip(value, value[1:], strict=False)) if p in table]
    heapq.heapify(queue)
    while queue:
        _, at, pair = heapq.heappop(queue)
        after = right[at]
        if after < 0 or (value[at], value[after]) != pair:
            continue  # one of its pieces has been joined to another since
        value[at], value[after] = table[pair][1], -1
        beyond = right[at] = right[after]
        if beyond >= 0:
            left[beyond] = at
        for first, second in ((left[at], at), (at, beyond)):
            if first >= 0 and second >= 0 and (fresh := (value[first], value[second])) in table:
                heapq.heappush(queue, (table[fresh][0], first, fresh))
    return [v for v in value if v >= 0]


def keys(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """A pair of symbols as one number."""
    return (left.astype(np.int64) << 32) | right


class Slice:
    """Some units: their symbols one after the other, and where each unit starts (and the last one ends)."""

    def __init__(self, flat: np.ndarray, starts: np.ndarray, columns: dict[str, np.ndarray]):
        self.flat, self.starts, self.columns = flat, starts, columns

    def pairs(self) -> np.ndarray:
        return keys(self.flat[:-1], self.flat[1:])

    def inside(self) -> np.ndarray:
        """Which neighbours are of one unit."""
        same = np.ones(max(0, len(self.flat) - 1), bool)
        borders = self.starts[(self.starts > 0) & (self.starts < len(self.flat))]
        same[borders - 1] = False
        return same

    def runs(self, hot: np.ndarray) -> np.ndarray:
        """Where the runs of hot pairs start; other symbols are runs of their own."""
        pairs = self.pairs()
        found = hot[np.minimum(np.searchsorted(hot, pairs), len(hot) - 1)] == pairs
        return np.concatenate([np.zeros(1, np.int64), np.flatnonzero(~(found & self.inside())) + 1])

    def unit_of(self, at: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.starts, at, "right") - 1


def sliced(batches: Iterator[pa.RecordBatch], size: int = SLICE) -> Iterator[Slice]:
    for batch in batches:
        ids = batch.column(batch.schema.get_field_index("ids"))
        starts, flat = ids.offsets.to_numpy().astype(np.int64), ids.values.to_numpy()
        columns = {n: batch.column(k).to_numpy() for k, n in enumerate(batch.schema.names) if n != "ids"}
        begin = 0
        while begin < len(ids):
            end = max(begin + 1, int(np.searchsorted(starts, starts[begin] + size, "right")) - 1)
            if starts[end] > starts[begin]:
                yield Slice(np.ascontiguousarray(flat[starts[begin] : starts[end]]), starts[begin : end + 1] - starts[begin],
                            {n: c[begin:end] for n, c in columns.items()})
            begin = end


def pieces(flat: np.ndarray, starts: np.ndarray) -> pa.Array:
    """The runs as byte strings."""
    ends = np.append(starts, len(flat)) * 4
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(ends), pa.py_buffer(flat)])


def lists(starts: np.ndarray, flat: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(starts, pa.int32()), pa.array(flat, pa.int32()))


def symbols_of(strings: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Starts (and the last end) and symbols of byte strings."""
    starts = np.concatenate([np.zeros(1, np.int64), np.cumsum(pc.binary_length(strings).to_numpy() // 4)])
    whole = b"".join(strings.to_pylist()) if strings.offset or not len(strings) else strings.buffers()[2]
    return starts, np.frombuffer(whole, np.int32)[: starts[-1]]


def cut(units: DataFrame, hot: np.ndarray, by_first: bool) -> DataFrame:
    """The distinct runs of ``hot`` pairs (sorted :func:`keys`), how often they occur, and the first place."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in sliced(batches):
            starts = part.runs(hot)
            long = np.diff(np.append(starts, len(part.flat))) > 1
            if not long.any():
                continue
            coded = pieces(part.flat, starts).filter(pa.array(long)).dictionary_encode()
            code, count = coded.indices.to_numpy(), len(coded.dictionary)
            starts = starts[long]
            unit = part.unit_of(starts)
            freq = np.zeros(count, np.int64)
            np.add.at(freq, code, part.columns["freq"][unit])
            seq, place = np.zeros(count, np.int64), np.zeros(count, np.int64)
            if by_first:
                seqs = part.columns["seq"][unit]
                places = starts - part.starts[unit] + (part.columns["place"][unit] if "place" in part.columns else 0)
                order = np.lexsort((places, seqs))[::-1]
                first = np.zeros(count, np.int64)
                first[code[order]] = order  # the last one written is the first in the corpus
                seq, place = seqs[first], places[first]
            yield pa.RecordBatch.from_arrays([pa.array(seq), pa.array(place), pa.array(freq), lists(*symbols_of(coded.dictionary))],
                                             ["seq", "place", "freq", "ids"])

    found = units.mapInArrow(run, RUNS).groupBy("ids").agg(F.min(F.struct("seq", "place")).alias("at"), F.sum("freq").alias("freq"))
    return found.select("at.seq", "at.place", "freq", "ids")


def added(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys and their summed counts."""
    key, count = (np.concatenate(x) for x in zip(*parts, strict=True))
    order = np.argsort(key, kind="stable")
    key = key[order]
    starts = np.flatnonzero(np.concatenate([np.ones(1, bool), key[1:] != key[:-1]]))
    return key[starts], np.add.reduceat(count[order], starts)


def merged(units: DataFrame, merges: list[tuple[int, int, int]], hot: np.ndarray) -> tuple[DataFrame, DataFrame, str]:
    """The units of two symbols or more after ``merges`` of hot pairs, ``a, b, cnt`` of their pairs, and the folder that holds both."""
    table = {(a, b): (rank, new) for rank, (a, b, new) in enumerate(merges)}

    def after(part: Slice, known: dict[bytes, bytes]) -> Slice:
        runs = part.runs(hot)
        coded = pieces(part.flat, runs).dictionary_encode()
        forms = []
        for raw in coded.dictionary.to_pylist():
            form = known.get(raw)
            if form is None:
                if len(known) >= HELD:
                    known.clear()
                form = known[raw] = np.array(join_pieces(np.frombuffer(raw, np.int32).tolist(), table), np.int32).tobytes() if len(raw) > 4 else raw
            forms.append(form)
        starts, flat = symbols_of(pa.array(forms, pa.large_binary()).take(coded.indices))
        return Slice(flat, starts[np.searchsorted(runs, part.starts)], part.columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[bytes, bytes] = {}
        counts: list[tuple[np.ndarray, np.ndarray]] = []
        for part in sliced(batches):
            if merges:
                part = after(part, known)
            size, seq, freq = np.diff(part.starts), part.columns["seq"], part.columns["freq"]
            alive = pa.array(size > 1)
            kinds = pa.array(np.zeros(len(size), np.int32))
            yield pa.RecordBatch.from_arrays([kinds, pa.array(seq), pa.array(freq), lists(part.starts, part.flat)], NAMES).filter(alive)
            at = np.flatnonzero(part.inside())
            if len(at):
                counts.append(added([(part.pairs()[at], freq[part.unit_of(at)])]))
                if sum(len(k) for k, _ in counts) > HELD:
                    counts = [added(counts)]
        if counts:
            key, count = added(counts)
            for k in range(0, len(key), 1 << 16):
                some, n = key[k : k + (1 << 16)], len(key[k : k + (1 << 16)])
                both = np.stack([some >> 32, some & 0xFFFFFFFF], 1).astype(np.int32).ravel()
                yield pa.RecordBatch.from_arrays([pa.array(np.ones(n, np.int32)), pa.array(np.zeros(n, np.int64)),
                                                  pa.array(count[k : k + (1 << 16)]), lists(np.arange(n + 1) * 2, both)], NAMES)

    spark = units.sparkSession
    path = scratch_path(spark, "bpe-runs")
    units.select("seq", "freq", "ids").mapInArrow(run, SCHEMA).write.parquet(path)
    result = spark.read.schema(SCHEMA).parquet(path)
    pairs = result.where("kind = 1").groupBy(F.col("ids")[0].alias("a"), F.col("ids")[1].alias("b")).agg(F.sum("freq").alias("cnt"))
    return result.where("kind = 0").select("seq", "freq", "ids"), pairs, path


def distinct_runs(units: DataFrame, best: list, width: int, work: int, by_first: bool) -> tuple[DataFrame | None, np.ndarray, int, int, str | None]:
    """The distinct runs of at most ``work`` symbols in all, their hot pairs, the floor, their symbols and folder.

    Starts from the ``width`` first pairs of ``best`` (``a, b, cnt``, counts falling; the last one
    is not taken) and takes fewer until the runs fit; no runs if not even those of the most frequent count do.
    """
    counts = np.array([r[2] for r in best], np.int64)
    source, older = units, None
    while True:
        floor = int(counts[min(width, len(counts) - 1)])
        taken = int(np.sum(counts > floor))
        if not taken:  # the first ones tie
            taken = int(np.sum(counts == counts[0]))
            floor = int(counts[taken])
        hot = np.sort(np.array([(r[0] << 32) | r[1] for r in best[:taken]], np.int64))
        path = scratch_path(units.sparkSession, "bpe-cut")
        cut(source, hot, by_first).write.parquet(path)
        if older:
            remove_now(units.sparkSession, older)
        source, older = units.sparkSession.read.schema(RUNS).parquet(path), path
        size = source.agg(F.sum(F.size("ids"))).first()[0] or 0
        if size <= work:
            return source, hot, floor, size, path
        if counts[taken - 1] == counts[0]:
            remove_now(units.sparkSession, path)
            return None, hot, floor, size, None
        width = max(1, min(taken - 1, int(taken * max(0.1, min(0.7, work / size)))))
