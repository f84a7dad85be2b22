"""Phrase collocations from count streams in prefix and suffix order.

The layout is that of external stream estimation of n-gram statistics:

1. *Counting.*  Tasks hold their texts as streams of word numbers, count n-grams
   by sorting them chunk by chunk, and Spark adds the chunks' counts up.  Only
   n-grams found ``least`` times or more go on: every part of a candidate occurs
   at least as often as the candidate, so all that is looked up later is there.
   Before that, a sketch of the corpus' word pairs (:data:`SKETCH_BITS` counters,
   a fixed size) tells each task which pairs can reach ``least`` at all; longer
   n-grams with a pair that cannot are not sent.  The sketch can only let through
   too much, never too little, so it does not change the result.
2. *Suffix order.*  The count stream is range partitioned and sorted by the
   reversed words.  There an n-gram follows its own suffixes, and is followed by
   its extensions to the left.
3. *Prefix order.*  The stream, with what step 2 found, is sorted by its words.
   There an n-gram follows its prefixes and is followed by its extensions to the
   right.

:func:`lockstep` walks such a sorted stream once, all orders of n-grams side by
side, holding the last n-gram of each order: that gives every n-gram the counts of
all its prefixes (suffixes) and the largest count among its extensions, with
neither a hash table nor a look-up.  Groups may cross partition borders: a first
pass takes one short row per partition to the driver, from which the n-grams that
are open at each border follow.

Scores are exact (Python integers; products may pass 64 bits).  Defined results:
a null text counts as empty, a null language as ``und``; an empty table gives
no rows; repeated rows count as often as they occur; row order, ids and other
columns do not matter.  Equal scores rank by count, then by phrase (byte order).
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import ranged, slices, written
from tessera.operators.counting import counted

# Characters that end a piece, and a token that is one of them or a word.
PIECE_ENDS = ".,;:!?\n\x0b\x0c\r"
TOKEN = re.compile(r"[.,;:!?\x0A-\x0D]|[^\x20\x09.,;:!?\x0A-\x0D]+")

#: Words of a task that are counted at a time.
CHUNK = 1_000_000
#: Characters of a text that are split into words at a time (cut at the end of a piece).
STRETCH = 1_000_000
#: Counters of the sketch of word pairs, as a power of two; they are sent in slices.
SKETCH_BITS = 25
SLICE_BITS = 18


class Chunk:
    """Word numbers of some texts of one language; numbers below ``len(PIECE_ENDS)`` end a piece."""

    def __init__(self, lang: str):
        self.lang = lang
        self.numbers: defaultdict[str, int] = defaultdict()
        self.numbers.default_factory = self.numbers.__len__
        for c in PIECE_ENDS:
            self.numbers[c]
        self.parts: list[np.ndarray] = []
        self.size = 0

    def add(self, text: str) -> None:
        for stretch in stretches(text):
            tokens = TOKEN.findall(stretch)
            self.parts += [np.fromiter(map(self.numbers.__getitem__, tokens), np.int32, len(tokens)), np.zeros(1, np.int32)]
            self.size += len(tokens)

    def stream(self) -> np.ndarray:
        return np.concatenate(self.parts) if self.parts else np.zeros(0, np.int32)

    def marks(self) -> np.ndarray:
        """A 64-bit mark per word number, the same in every task."""
        import xxhash

        return np.array([xxhash.xxh64_intdigest(w.encode("utf-8", "surrogatepass")) for w in self.numbers], np.uint64)


def stretches(text: str, size: int = STRETCH) -> Iterator[str]:
    """The text in stretches that end with a piece, of ``size`` characters or more."""
    start = 0
    while len(text) - start > size:
        end = re.compile(r"[.,;:!?\x0A-\x0D]").search(text, start + size)
        if end is None:
            break
        yield text[start : end.end()]
        start = end.end()
    yield text[start:] if start else text


def chunks(batches: Iterator[pa.RecordBatch], size: int = CHUNK) -> Iterator[Chunk]:
    """The texts of a task by language, in chunks that together hold about ``size`` words at a time."""
    open_: dict[str, Chunk] = {}
    held = 0
    for batch in slices(batches):
        texts = pc.ascii_lower(batch.column(0))
        for text, lang in zip(texts.to_pylist(), batch.column(1).to_pylist(), strict=True):
            chunk = open_.get(lang) or open_.setdefault(lang, Chunk(lang))
            before = chunk.size
            chunk.add(text)
            held += chunk.size - before
            if held >= size:
                yield from closed(open_)
                held = 0
    yield from closed(open_)


def closed(open_: dict[str, Chunk]) -> Iterator[Chunk]:
    """Takes the chunks out one by one; their dictionaries go as soon as they are used."""
    while open_:
        chunk = open_.popitem()[1]
        yield chunk
        chunk.numbers.default_factory = None


def grams(stream: np.ndarray, order: int) -> np.ndarray:
    """Start positions of the n-grams of ``order`` words that do not cross the end of a piece."""
    if len(stream) < order:
        return np.zeros(0, np.int64)
    inside = stream >= len(PIECE_ENDS)
    whole = inside[: len(stream) - order + 1].copy()
    for k in range(1, order):
        whole &= inside[k : len(stream) - order + 1 + k]
    return np.flatnonzero(whole)


def pair_slots(marks: np.ndarray, lang: str, left: np.ndarray, right: np.ndarray, bits: int) -> np.ndarray:
    """The sketch's counter of each pair of word numbers."""
    import xxhash

    mixed = marks[left] * np.uint64(0x9E3779B97F4A7C15) + (marks[right] ^ np.uint64(xxhash.xxh64_intdigest(lang.encode("utf-8"))))
    mixed ^= mixed >> np.uint64(29)
    mixed *= np.uint64(0xBF58476D1CE4E5B9)
    mixed >>= np.uint64(64 - bits)
    return mixed.view(np.int64)


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.coalesce("text", F.lit("")).alias("text"), F.coalesce("lang", F.lit("und")).alias("lang"))


def frequent_pairs(docs: DataFrame, least: int, bits: int = SKETCH_BITS) -> bytes:
    """One bit per counter of the sketch: can a pair of this counter be found ``least`` times?"""
    top = min(least, 255)
    width = 1 << min(SLICE_BITS, bits)

    def sketch(batches):
        counters = np.zeros(1 << bits, np.uint8)
        for chunk in chunks(batches):
            stream, marks = chunk.stream(), chunk.marks()
            at = grams(stream, 2)
            found, n = np.unique(pair_slots(marks, chunk.lang, stream[at], stream[at + 1], bits), return_counts=True)
            # counters stop at `least`, which keeps them right up to there
            counters[found] = np.minimum(counters[found] + np.minimum(n, top), top)
        for k in range(0, len(counters), width):
            if counters[k : k + width].any():
                yield pa.RecordBatch.from_pydict({"at": [k], "counters": [counters[k : k + width].tobytes()]})

    def added(batches):
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for at, counters in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                own = sums.setdefault(at, np.zeros(width, np.uint8))
                np.minimum(own.astype(np.uint16) + np.frombuffer(counters.as_buffer(), np.uint8), top, out=own, casting="unsafe")
        for at, own in sums.items():
            yield pa.RecordBatch.from_pydict({"at": [at], "flags": [np.packbits(own >= top).tobytes()]})

    parts = _texts(docs).mapInArrow(sketch, "at long, counters binary").repartition(max(1, (1 << bits) // width), "at")
    flags = np.zeros((1 << bits) // 8, np.uint8)
    for r in parts.mapInArrow(added, "at long, flags binary").collect():  # 1 << bits bits in all
        flags[r["at"] // 8 : r["at"] // 8 + width // 8] = np.frombuffer(r["flags"], np.uint8)
    return flags.tobytes()


def count_stream(docs: DataFrame, longest: int, least: int, bits: int = SKETCH_BITS) -> DataFrame:
    """``lang, phrase, f`` of the n-grams of 1 to ``longest`` words found ``least`` times or more; a null phrase holds the count of all words."""
    flags = docs.sparkSession.sparkContext.broadcast(frequent_pairs(docs, least, bits))  # 1 << bits bits

    def count(batches):
        known = np.frombuffer(flags.value, np.uint8)
        for chunk in chunks(batches):
            stream, marks = chunk.stream(), chunk.marks()
            words = pa.array(list(chunk.numbers), pa.string())
            at = grams(stream, 1)
            yield _rows(chunk.lang, pa.nulls(1, pa.string()), np.array([len(at)]))
            for order in range(1, longest + 1):
                if order > 1:
                    at = at[at <= len(stream) - order]
                    at = at[stream[at + order - 1] >= len(PIECE_ENDS)]  # the part before is whole and can be frequent
                    slots = pair_slots(marks, chunk.lang, stream[at + order - 2], stream[at + order - 1], bits)
                    at = at[(known[slots >> 3] >> (7 - (slots & 7)).astype(np.uint8)) & 1 == 1]
                columns, n = counted([stream[at + k] for k in range(order)])
                for k in range(0, len(n), 1 << 16):
                    part = [words.take(pa.array(c[k : k + (1 << 16)])) for c in columns]
                    yield _rows(chunk.lang, pc.binary_join_element_wise(*part, " ") if order > 1 else part[0], n[k : k + (1 << 16)])

    found = _texts(docs).mapInArrow(count, "lang string, phrase string, n long")
    return found.groupBy("lang", "phrase").agg(F.sum("n").alias("f")).where((F.col("f") >= least) | F.col("phrase").isNull())


def _rows(lang: str, phrases: pa.Array, n: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([lang] * len(phrases), pa.string()), phrases, pa.array(n, pa.int64())], ["lang", "phrase", "n"])


# ---------------------------------------------------------------- streams

def lockstep(stream: DataFrame, words: str, longest: int, below: str, extension: str) -> DataFrame:
    """Counts of the shorter n-grams at the front of ``words``, and the largest count of a one-word extension.

    ``stream`` is :func:`ranged` by ``lang, words`` and holds with an n-gram all
    that start it.  ``below`` becomes an array with the counts of the first 1, 2,
    ... words, ``extension`` the largest ``f`` of an n-gram one word longer that
    starts with this one (0: none).
    """
    levels = range(1, longest)  # n-grams of full length have no extension here
    at_words, at_f = stream.columns.index(words), stream.columns.index("f")

    def ends(batches):
        """What a partition leaves open, and what it has for those that an earlier one left open."""
        closed, last, head = [False] * longest, [None] * longest, [0] * longest
        for batch in batches:
            orders, f = _orders(batch.column(at_words)), batch.column(at_f).to_numpy()
            for level in levels:
                stops = np.flatnonzero(orders <= level)
                upto = stops[0] if len(stops) else len(orders)
                if not closed[level]:
                    head[level] = max(head[level], int(f[:upto][orders[:upto] == level + 1].max(initial=0)))
                if len(stops):
                    closed[level] = True
                    last[level] = int(f[stops[-1]]) if orders[stops[-1]] == level else None
        from pyspark import TaskContext

        yield pa.RecordBatch.from_pydict(
            {"pid": [TaskContext.get().partitionId()], "closed": [closed], "last": [last], "head": [head]},
            pa.schema([("pid", pa.int64()), ("closed", pa.list_(pa.bool_())), ("last", pa.list_(pa.int64())), ("head", pa.list_(pa.int64()))]),
        )

    borders = sorted(stream.mapInArrow(ends, "pid long, closed array<boolean>, last array<long>, head array<long>").collect())  # a row per partition
    before, beyond = _across(borders, longest)
    fields = ", ".join([*(f"`{x.name}` {x.dataType.simpleString()}" for x in stream.schema), f"`{below}` array<long>", f"`{extension}` long"])

    def walk(batches):
        from pyspark import TaskContext

        pid = TaskContext.get().partitionId()
        opened = before.get(pid, [None] * longest)  # counts of the n-grams that earlier partitions left open
        held: pa.RecordBatch | None = None  # open n-grams of this partition, whose extensions are not all known
        reach = np.zeros(0, np.int64)  # their largest extension so far
        for batch in batches:
            if not batch.num_rows:
                continue
            if len(reach):
                batch = pa.Table.from_batches([held, batch]).combine_chunks().to_batches()[0]
            orders, f = _orders(batch.column(at_words)), batch.column(at_f).to_numpy()
            largest = np.zeros(len(orders), np.int64)
            largest[: len(reach)] = reach
            fronts, waiting = _fronts(orders, f, largest, opened, longest)
            yield _with(batch, fronts, largest, ~waiting)
            held, reach = batch.filter(pa.array(waiting)), largest[waiting]
        if len(reach):
            orders, f = _orders(held.column(at_words)), held.column(at_f).to_numpy()
            fronts, _ = _fronts(orders, f, reach, opened, longest)
            tail = np.array([beyond.get((pid, int(o)), 0) for o in orders], np.int64)
            yield _with(held, fronts, np.maximum(reach, tail), np.ones(len(reach), bool))

    return stream.mapInArrow(walk, fields)


def _orders(words: pa.Array) -> np.ndarray:
    return pc.list_value_length(words).to_numpy(zero_copy_only=False).astype(np.int64)


def _across(borders: list, longest: int) -> tuple[dict, dict]:
    """Per partition, the open counts it starts with; per (partition, order), the largest extension found in later ones."""
    before, beyond = {}, {}
    open_ = [None] * longest
    owner = [None] * longest
    for b in borders:
        before[b["pid"]] = list(open_)
        for level in range(1, longest):
            if owner[level] is not None:
                key = (owner[level], level)
                beyond[key] = max(beyond.get(key, 0), b["head"][level])
            if b["closed"][level]:
                open_[level] = b["last"][level]
                owner[level] = b["pid"] if b["last"][level] is not None else None
    return before, beyond


def _fronts(orders: np.ndarray, f: np.ndarray, largest: np.ndarray, opened: list, longest: int) -> tuple[list[np.ndarray], np.ndarray]:
    """For each level, the count of the n-gram of that order that each row starts with; which rows still wait for extensions.

    ``largest`` is raised in place by the extensions among the rows.
    """
    fronts, waiting = [], np.zeros(len(orders), bool)
    for level in range(1, longest):
        place = np.where(orders == level, np.arange(len(orders)), -1)
        place = np.maximum.accumulate(place)
        fronts.append(np.where(place >= 0, f[place], opened[level] or 0))
        longer = np.flatnonzero((orders == level + 1) & (place >= 0))
        np.maximum.at(largest, place[longer], f[longer])
        stops = np.flatnonzero(orders <= level)
        if len(stops) and orders[stops[-1]] == level:
            waiting[stops[-1]] = True
    return fronts, waiting


def _with(batch: pa.RecordBatch, fronts: list[np.ndarray], largest: np.ndarray, keep: np.ndarray) -> pa.RecordBatch:
    ends = pa.array(np.arange(batch.num_rows + 1) * len(fronts), pa.int32())
    below = pa.ListArray.from_arrays(ends, pa.array(np.stack(fronts, 1).ravel(), pa.int64()))
    whole = pa.RecordBatch.from_arrays([*batch.columns, below, pa.array(largest, pa.int64())], names=[*batch.schema.names, "_below", "_extension"])
    return whole.filter(pa.array(keep))


def cut_score(a: int, left: int, right: int) -> int:
    return 1_000_000 * a * a // (left * right)


def score(candidates: DataFrame) -> DataFrame:
    """``l``, ``r`` and ``score`` of the lowest-scoring cut (ties: the earliest) from the counts of prefixes and suffixes."""
    at = {c: candidates.columns.index(c) for c in ("words", "f", "prefixes", "suffixes")}

    def run(batches):
        for batch in batches:
            cuts = []
            for n, a, prefixes, suffixes in zip(_orders(batch.column(at["words"])).tolist(), *(batch.column(at[c]).to_pylist() for c in ("f", "prefixes", "suffixes")), strict=True):
                # after k words: the first k, and the last n - k
                low, k = min((cut_score(a, prefixes[k - 1], suffixes[n - k - 1]), k) for k in range(1, n))
                cuts.append((prefixes[k - 1], suffixes[n - k - 1], low))
            l, r, s = (pa.array([c[i] for c in cuts], pa.int64()) for i in range(3))  # noqa: E741
            phrases = pc.binary_join(batch.column(at["words"]), " ")
            yield pa.RecordBatch.from_arrays([batch.column(0), phrases, batch.column(at["f"]), l, r, s], ["lang", "phrase", "a", "l", "r", "score"])

    return candidates.mapInArrow(run, "lang string, phrase string, a long, l long, r long, score long")


def collocations(docs: DataFrame, longest: int = 3, least: int = 10, covered_percent: int = 50, top: int = 2000, bits: int = SKETCH_BITS) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: each language's ``top`` phrases of 2 to ``longest`` words.

    A phrase found ``a >= least`` times is left out if a longer one that holds it
    is found at least ``covered_percent`` percent as often (and ``least`` times).
    """
    counts = written(count_stream(docs, longest, least, bits), "counts")
    totals = counts.where("phrase IS NULL").select("lang", F.col("f").alias("n"))
    stream = counts.where("phrase IS NOT NULL").select("lang", F.split("phrase", " ").alias("words"), "f")
    suffix = ranged(stream.withColumn("back", F.reverse("words")), ["lang", "back"])
    suffix = lockstep(suffix, "back", longest, "suffixes", "left_extension").drop("back")
    prefix = ranged(written(suffix, "suffix-stream"), ["lang", "words"])
    merged = lockstep(prefix, "words", longest, "prefixes", "right_extension")
    longer = F.greatest("left_extension", "right_extension")
    alone = merged.where((F.size("words") >= 2) & ~((100 * longer >= covered_percent * F.col("f")) & (longer > 0)))
    best = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), F.asc("phrase"))
    first = score(alone).select("*", F.row_number().over(best).alias("rank")).where(F.col("rank") <= top)
    return first.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
