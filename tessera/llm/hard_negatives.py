"""Hard negatives: near misses of another label for every (anchor, positive) pair, by Kronecker-packed products.

Components are quantised to integers.  In a block, several candidates' values of
one dimension are biased to be non-negative and laid side by side into the
fields of one wide integer; an anchor multiplies that integer once per
component, and the sum of the products holds every candidate's biased inner
product in its own field, exactly (a field is wide enough for the largest
possible sum, so no carry crosses into the next one).  Taking the biases off
gives the exact scores.

Anchors (a stated query set that grows with the table) and candidates are dealt
by hash into a grid of cells of bounded average size, so neither side is ever
whole in a task, and a hot label is spread like any other.  Two passes: the
first multiplies an anchor with its own label's packs and keeps the best
positives, the second with the other labels' packs and keeps, per positive, the
best negatives inside the score window.  Cells return their own best few; a
window (limited before its shuffle) picks the best of all cells.

Defined results: rows with a null id, label or vector, or with a null or
non-finite component, take no part.  A vector shorter than another counts as
padded with zeros; an empty one scores 0.  Rows that repeat a (vec_id, score)
count once; rows with an anchor's vec_id are never its partners, and of several
such rows the one with the smallest label and vector is the anchor.
Scores beyond 64 bits are the nearest long.  Fewer partners than asked for: all
of them; an anchor without positives or negatives has no rows.  Columns other
than the three named ones are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass
from operator import mul

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import written

#: Candidates whose components share one wide integer.
PACK = 1024
LONG_MIN, LONG_MAX = -(2**63), 2**63 - 1


@dataclass(frozen=True)
class MiningRules:
    """``low_percent`` and ``high_percent`` bound a negative's score by its positive's score."""

    positives: int = 5
    negatives: int = 3
    low_percent: int = 50
    high_percent: int = 95
    scale: int = 256


def quantised(vectors: pa.ListArray, scale: int) -> list[list[int]]:
    """``floor(scale * x)`` of every component, as Python integers."""
    if isinstance(vectors, pa.ChunkedArray):
        vectors = vectors.combine_chunks()
    flat = np.floor(vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64) * scale)
    exact = flat.astype(np.int64).tolist() if not len(flat) or np.abs(flat).max() < 2**62 else [int(x) for x in flat.tolist()]
    ends = np.cumsum(vectors.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)).tolist()
    return [exact[a:b] for a, b in zip([0, *ends[:-1]], ends, strict=True)] if ends else []


class Pack:
    """Up to :data:`PACK` candidates, one wide integer per dimension.

    ``reach`` is the largest absolute component of the anchors that will multiply
    it; it fixes the field width together with the pack's own components.
    """

    def __init__(self, rows: list[list[int]], reach: int):
        dims = max(map(len, rows), default=0)
        rows = [r + [0] * (dims - len(r)) for r in rows]
        self.count, self.dims, self.reach = len(rows), dims, reach
        self.bias = max((abs(x) for r in rows for x in r), default=0)
        # a sum of dims products, each at most (2 * bias) * (2 * reach), stays inside its field
        self.width = next((w for w in (4, 8) if dims * 4 * self.bias * reach < 1 << 8 * w), 0) or ((dims * 4 * self.bias * reach).bit_length() + 7) // 8
        self.wide = [self._joined([r[d] + self.bias for r in rows]) for d in range(dims)]
        self.sums = [sum(r) for r in rows]

    def _joined(self, fields: list[int]) -> int:
        if self.width in (4, 8):
            return int.from_bytes(np.array(fields, "<u4" if self.width == 4 else "<u8").tobytes(), "little")
        return int.from_bytes(b"".join(x.to_bytes(self.width, "little") for x in fields), "little")

    def scores(self, anchor: list[int]) -> np.ndarray:
        """Exact inner products of ``anchor`` with every packed candidate (as the nearest long)."""
        anchor = (anchor + [0] * (self.dims - len(anchor)))[: self.dims]
        biased = [x + self.reach for x in anchor]
        total = sum(map(mul, biased, self.wide))  # one product per component for all candidates
        raw = total.to_bytes(self.width * self.count, "little") if self.count else b""
        # (a + reach)(c + bias) = ac + a * bias + reach * c + reach * bias, summed over the dimensions
        offset = self.bias * sum(anchor) + self.dims * self.reach * self.bias
        if self.width in (4, 8):
            fields = np.frombuffer(raw, "<u4" if self.width == 4 else "<u8")
            if abs(offset) < 2**62 and self.reach * max(map(abs, self.sums), default=0) < 2**62 and (self.width == 4 or not len(fields) or fields.max() < 2**62):
                return fields.astype(np.int64) - offset - self.reach * np.array(self.sums, np.int64)
            fields = fields.tolist()
        else:
            fields = [int.from_bytes(raw[k : k + self.width], "little") for k in range(0, len(raw), self.width)]
        return np.array([min(max(f - offset - self.reach * s, LONG_MIN), LONG_MAX) for f, s in zip(fields, self.sums, strict=True)], np.int64)


class Cell:
    """One cell's candidates, packed by label and ordered by ``vec_id``."""

    def __init__(self, table: pa.Table, scale: int, reach: int):
        rows = quantised(table["_v"], scale)
        ids, labels = table["vec_id"].to_numpy(), table["_label"].to_numpy()
        order = np.lexsort((ids, labels))
        self.by_label: dict[int, list[tuple[np.ndarray, Pack]]] = {}
        for label in np.unique(labels):
            own = order[labels[order] == label]
            self.by_label[int(label)] = [
                (ids[part], Pack([rows[i] for i in part], reach)) for part in (own[k : k + PACK] for k in range(0, len(own), PACK))
            ]

    def scored(self, anchor_id: int, vector: list[int], packs: list[tuple[np.ndarray, Pack]]) -> tuple[np.ndarray, np.ndarray]:
        """Scores and ids of the packed candidates, without the anchor's own id."""
        if not packs:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        scores = np.concatenate([p.scores(vector) for _, p in packs])
        ids = np.concatenate([i for i, _ in packs])
        return scores[keep := ids != anchor_id], ids[keep]


def best_first(scores: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Positions by descending score, then ascending id, repeats of a pair left out."""
    order = np.lexsort((ids, ~scores))  # ~x = -x - 1 orders downwards without overflow
    again = np.zeros(len(order), bool)
    again[1:] = (scores[order][1:] == scores[order][:-1]) & (ids[order][1:] == ids[order][:-1])
    return order[~again]


def _usable(df: DataFrame) -> DataFrame:
    """``vec_id``, ``_label`` (long) and ``_v`` of the rows that take part."""
    finite = F.forall("_v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))))
    rows = df.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("_label"), F.col("embedding").alias("_v"))
    return rows.where("vec_id IS NOT NULL AND _label IS NOT NULL AND _v IS NOT NULL").where(finite)


def _dealt(rows: DataFrame, anchors: DataFrame, cell_rows: int, cell_anchors: int) -> tuple[DataFrame, DataFrame]:
    """Both sides with the cells ``(_a, _c)`` of the grid that they belong to."""
    spark = rows.sparkSession
    at_least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    n_c = max(at_least, -(-rows.count() // cell_rows))
    n_a = max(1, -(-anchors.count() // cell_anchors))
    cell = lambda n: F.pmod(F.xxhash64("vec_id"), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    return rows.select("*", cell(n_c).alias("_c"), every(n_a).alias("_a")), anchors.select("*", cell(n_a).alias("_a"), every(n_c).alias("_c"))


def _crossed(rows: DataFrame, anchors: DataFrame, rules: MiningRules, own_label: bool, find, schema: str, cell_rows: int, cell_anchors: int) -> DataFrame:
    """``find(anchor row, scores, ids)`` for every anchor and cell; scores are those of its own label or of the others."""
    left, right = _dealt(rows, anchors, cell_rows, cell_anchors)
    names = [f.split()[0] for f in schema.split(", ")]
    types = pa.schema([(n, pa.int64()) for n in names])

    def cross(candidates: pa.Table, asking: pa.Table) -> pa.Table:
        out: dict[str, list] = {n: [] for n in names}
        if not candidates.num_rows or not asking.num_rows:
            return pa.table(out, types)
        vectors = quantised(asking["_v"], rules.scale)
        cell = Cell(candidates, rules.scale, max((abs(x) for v in vectors for x in v), default=0))
        for vector, row in zip(vectors, asking.drop_columns(["_v", "_a", "_c"]).to_pylist(), strict=True):
            own = cell.by_label.get(row["_label"], [])
            packs = own if own_label else [p for label, ps in cell.by_label.items() if label != row["_label"] for p in ps]
            for found in find(row, *cell.scored(row["vec_id"], vector, packs)):
                for n, x in zip(names, found, strict=True):
                    out[n].append(x)
        return pa.table(out, types)

    return left.groupBy("_a", "_c").cogroup(right.groupBy("_a", "_c")).applyInArrow(cross, schema)


def _first(df: DataFrame, keys: list[str], score: str, partner: str, n: int, rank: str) -> DataFrame:
    """The ``n`` best partners of each key over all cells, with their rank."""
    best = Window.partitionBy(*keys).orderBy(F.desc(score), F.asc(partner))
    return df.select("*", F.row_number().over(best).alias(rank)).where(F.col(rank) <= n)


def mine(df: DataFrame, anchor_every: int = 50, rules: MiningRules = MiningRules(), shift_every: int | None = 7, n_labels: int = 10,
         cell_rows: int = 8192, cell_anchors: int = 1024) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score`` for every anchor and positive.

    ``shift_every`` moves the label of the ids that it divides to the next of
    ``n_labels`` (``None``: labels as they are).  ``cell_rows`` and ``cell_anchors``
    size the cells of the grid and do not change the result.
    """
    rows = _usable(df)
    if shift_every:
        rows = rows.withColumn("_label", F.when(F.col("vec_id") % shift_every == 0, (F.col("_label") + 1) % n_labels).otherwise(F.col("_label")))
    rows = written(rows, "vectors")
    one = F.min(F.struct("_label", "_v")).alias("_row")
    anchors = written(rows.where(F.col("vec_id") % anchor_every == 0).groupBy("vec_id").agg(one).select("vec_id", "_row.*"), "anchors")

    def nearest(row: dict, scores: np.ndarray, ids: np.ndarray):
        order = best_first(scores, ids)[: rules.positives]
        for score, partner in zip(scores[order].tolist(), ids[order].tolist(), strict=True):
            yield row["vec_id"], partner, score

    found = _crossed(rows, anchors, rules, True, nearest, "anchor_id long, positive_id long, positive_score long", cell_rows, cell_anchors)
    positives = written(_first(found, ["anchor_id"], "positive_score", "positive_id", rules.positives, "_p").drop("_p"), "positives")
    # at most `positives` entries per anchor
    packed = positives.groupBy(F.col("anchor_id").alias("vec_id")).agg(F.collect_list(F.struct("positive_id", "positive_score")).alias("_positives"))

    def misses(row: dict, scores: np.ndarray, ids: np.ndarray):
        low, high = rules.low_percent, rules.high_percent
        # low * p <= 100 * s <= high * p, on integers
        spans = [(-(-low * p["positive_score"] // 100), high * p["positive_score"] // 100, p) for p in row["_positives"]]
        spans = [s for s in spans if s[0] <= s[1]]
        if not spans:
            return
        near = np.flatnonzero((scores >= max(min(s[0] for s in spans), LONG_MIN)) & (scores <= min(max(s[1] for s in spans), LONG_MAX)))
        scores, ids = scores[near], ids[near]
        order = best_first(scores, ids)
        scores, ids = scores[order], ids[order]
        downwards = ~scores
        for floor, ceiling, p in spans:
            start = int(np.searchsorted(downwards, ~min(max(ceiling, LONG_MIN), LONG_MAX)))
            for score, partner in zip(scores[start : start + rules.negatives].tolist(), ids[start : start + rules.negatives].tolist(), strict=True):
                if score >= floor:
                    yield row["vec_id"], p["positive_id"], p["positive_score"], partner, score

    found = _crossed(rows, written(anchors.join(packed, "vec_id"), "asking"), rules, False, misses,
                     "anchor_id long, positive_id long, positive_score long, negative_id long, negative_score long", cell_rows, cell_anchors)
    ranked = _first(found, ["anchor_id", "positive_id", "positive_score"], "negative_score", "negative_id", rules.negatives, "rank")
    return ranked.select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score")
