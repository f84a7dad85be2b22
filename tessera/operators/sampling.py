"""Reproducible splitting, sampling and labelling support (Q1-Q10).

Every random choice is a keyed hash (``md5(key || seed)`` where DuckDB must
agree, ``xxhash64`` elsewhere), never ``rand()``: a retried task or a
different partitioning picks the same rows.  Exact-size splits number rows
globally with :func:`tessera.operators.ranking.global_row_number`
(range-partitioned, no single-task window).
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from tessera.operators.ranking import global_row_number
from tessera.session import cut_lineage


def hash_key(key: str, seed) -> Column:
    """First 8 hex digits of ``md5(key || seed)``: fixed width, so string order = numeric order."""
    return F.substring(F.md5(F.concat(F.col(key).cast("string"), F.lit(str(seed)))), 1, 8)


def split_hash(df: DataFrame, key: str, frac: float, seed="0") -> tuple[DataFrame, DataFrame]:
    """Q2: approximate split, ``frac`` of the keys go to the first part (stable under re-partitioning)."""
    h = F.conv(hash_key(key, seed), 16, 10).cast("long")
    thr = F.lit(int(frac * 2 ** 32)).cast("long")  # 0 takes nothing, 2**32 everything
    return df.where(h < thr), df.where(h >= thr)


def split_exact(df: DataFrame, key: str, fracs=(0.7, 0.2, 0.1), seed="0",
                names=("train", "valid", "test")) -> DataFrame:
    """Q1: seeded shuffle then exact cuts ``int(f1 n)``, ``int((f1+f2) n)``, ... (last part takes the rest).

    Adds a ``split`` column; the shuffle order is ``md5(key || seed)`` then key.
    """
    n = df.count()
    cuts, acc = [], 0.0
    for f in fracs[:-1]:
        acc += f
        cuts.append(int(round(acc, 12) * n))  # 0.7 + 0.2 must cut at int(0.9 n), not int(0.8999.. n)
    ranked = global_row_number(df.withColumn("_h", hash_key(key, seed)), ["_h", key], "_rn")
    label = F.lit(names[len(fracs) - 1])
    for cut, name in reversed(list(zip(cuts, names))):
        label = F.when(F.col("_rn") <= cut, F.lit(name)).otherwise(label)
    return ranked.withColumn("split", label).drop("_h", "_rn")


def split_ordered(df: DataFrame, order: list, key: str, train_ratio: float, valid_ratio: float) -> DataFrame:
    """Q3: split by position in ``order``: first ``int(r1 n)`` train, up to ``int((r1+r2) n)`` valid, rest test."""
    if train_ratio + valid_ratio >= 1:
        raise ValueError("The sum of training and validation ratio must be below 1")
    n = df.count()
    n_train, n_valid = int(n * train_ratio), int(n * (train_ratio + valid_ratio))
    ranked = global_row_number(df, list(order) + [key], "_rn")
    return ranked.withColumn("split", F.when(F.col("_rn") <= n_train, "train")
                             .when(F.col("_rn") <= n_valid, "valid").otherwise("test")).drop("_rn")


def split_semi(df: DataFrame, key: str, train_pct: float, val_pct: float, seed="42") -> DataFrame:
    """Q5: labelled / validation / unlabelled subsets by percent after a seeded shuffle."""
    n = df.count()
    n_train = int(train_pct / 100 * n)
    n_val = int(val_pct / 100 * n)
    ranked = global_row_number(df.withColumn("_h", hash_key(key, seed)), ["_h", key], "_rn")
    return ranked.withColumn("split", F.when(F.col("_rn") <= n_train, "labelled")
                             .when(F.col("_rn") <= n_train + n_val, "validation").otherwise("unlabelled")).drop(
        "_h", "_rn")


def node_masks(nodes: DataFrame, key: str, valid: DataFrame, test: DataFrame, extra_rate: float = 0.0,
               seed="0") -> DataFrame:
    """Q4: train/valid/test mask flags per node; optionally mask a further
    ``int(extra_rate * n)`` of the remaining nodes from training, chosen by hash rank."""
    v = valid.select(key).distinct().withColumn("_v", F.lit(1))
    t = test.select(key).distinct().withColumn("_t", F.lit(1))
    d = nodes.join(v, key, "left").join(t, key, "left")
    d = d.select("*", F.coalesce("_v", F.lit(0)).alias("valid_mask"), F.coalesce("_t", F.lit(0)).alias("test_mask"))
    d = d.withColumn("train_mask", ((F.col("valid_mask") == 0) & (F.col("test_mask") == 0)).cast("int"))
    d = d.drop("_v", "_t")
    if extra_rate and extra_rate < 1:
        k = int(extra_rate * nodes.count())
        un = d.where(F.col("train_mask") == 1).select(key, hash_key(key, seed).alias("_h"))
        pick = global_row_number(un, ["_h", key], "_rn").where(F.col("_rn") <= k).select(key, F.lit(1).alias("_x"))
        d = d.join(pick, key, "left").withColumn(
            "train_mask", F.when(F.col("_x") == 1, 0).otherwise(F.col("train_mask"))).drop("_x")
    return d


def select_uncertain(df: DataFrame, item: str, conf: str, threshold: float = 0.5, band: float = 0.1,
                     n: int = 5, literal_order: bool = False) -> DataFrame:
    """Q6: items whose mean confidence is within ``band`` of ``threshold``, at most ``n``.

    Default order: closest to the threshold first (ties by item).  ``literal_order``
    keeps the reference's choice of the largest item ids.
    """
    m = df.groupBy(item).agg(F.avg(conf).alias("mean_conf"))
    m = m.where(F.abs(F.col("mean_conf") - threshold) < band)
    order = [F.desc(item)] if literal_order else [F.abs(F.col("mean_conf") - threshold), item]
    return m.orderBy(*order).limit(n)


def select_by_entropy(df: DataFrame, item: str, prob: str, n: int = 5) -> DataFrame:
    """Q7: items with the largest entropy ``-sum p log(1e-9 + p)`` of their probabilities."""
    e = df.groupBy(item).agg((-F.sum(F.col(prob) * F.log(F.col(prob) + 1e-9))).alias("entropy"))
    return e.orderBy(F.desc("entropy"), item).limit(n)


def select_by_variance(df: DataFrame, item: str, cell: list[str], prob: str, n: int = 5) -> DataFrame:
    """Q8: mean over cells of the sample variance across repeated (MC) predictions; top ``n``."""
    v = df.groupBy(item, *cell).agg(F.var_samp(prob).alias("_v"))
    return v.groupBy(item).agg(F.avg("_v").alias("variance")).orderBy(F.desc("variance"), item).limit(n)


@F.pandas_udf(DoubleType())
def _beta_draw(seed: pd.Series, alpha: pd.Series) -> pd.Series:
    """Beta(alpha, alpha) draw per row from a per-row seeded generator (reproducible)."""
    out = np.empty(len(seed))
    for i, (s, a) in enumerate(zip(seed.to_numpy(), alpha.to_numpy())):
        out[i] = np.random.default_rng(int(s) & 0x7FFFFFFFFFFFFFFF).beta(a, a)
    return pd.Series(out)


def mixup(df: DataFrame, key: str, features: str, label: str, alpha: float = 0.4, seed: int = 0) -> DataFrame:
    """Q9: MixUp with a shuffled partner: ``x = l x_i + (1-l) x_j``, same for the label,
    ``l ~ Beta(alpha, alpha)``.  The partner of the i-th row in hash order is the
    (i+1)-th (cyclic): a 1:1 equi-join on positions, no n x n pairing."""
    n = df.count()
    r = global_row_number(df.withColumn("_h", F.xxhash64(F.lit(seed), F.col(key))), ["_h", key], "_rn")
    partner = r.select(F.col("_rn").alias("_prn"), F.col(key).alias("partner"),
                       F.col(features).alias("_xf"), F.col(label).alias("_yf"))
    j = r.withColumn("_prn", F.col("_rn") % F.lit(n) + 1).join(partner, "_prn")
    lam = _beta_draw(F.xxhash64(F.lit(seed + 1), F.col(key)), F.lit(float(alpha)))
    j = j.withColumn("lam", lam)
    mixed = F.zip_with(features, "_xf", lambda a, b: F.col("lam") * a + (1 - F.col("lam")) * b)
    return j.select(key, "partner", "lam", mixed.alias(features),
                    (F.col("lam") * F.col(label) + (1 - F.col("lam")) * F.col("_yf")).alias(label))


#: Label cells per sigma; proposals per row and round; rounds before the nearest label is taken; slack of the bound against rounding.
CELLS_PER_SIGMA, PROPOSALS, ROUNDS, SLACK = 4, 16, 50, 1e-9
#: What a proposal holds: its number, the place and the distance of its cell, and the luck that it has to pass.
DRAWN = ["_m", "_place", "_gap", "_luck"]


def _uniform(h: np.ndarray, stream: int) -> np.ndarray:
    """Numbers in [0, 1) from 64-bit keys, another sequence for each stream (splitmix64)."""
    x = h.astype(np.uint64) + np.uint64((stream + 1) * 0x9E3779B97F4A7C15 % 2**64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return ((x ^ (x >> np.uint64(31))) >> np.uint64(11)) / float(1 << 53)


def _proposals(cells: list, sigma: float):
    """Arrow UDFs ``(label, key hash, luck of each proposal) -> proposals``, one for the first proposals and one for the
    ``late`` ones: rows drawn by cell size times the cell's largest weight, which its distance ``gap`` (in sigma) gives.
    A proposal whose luck passes at the far end of its cell is the last of the first ones."""
    low, high, size, first = (np.array([r[c] for r in cells], float) for c in ("lo", "hi", "n", "first"))
    at_once = max(1, (1 << 20) // len(size))  # rows whose weights of all cells are held together

    def run(y: pa.Array, h: pa.Array, luck: pa.Array, late: bool) -> pa.Array:
        values, keys = y.to_numpy(zero_copy_only=False), h.to_numpy(zero_copy_only=False)
        where, inside = (np.stack([_uniform(keys, 2 * m + j) for m in range(PROPOSALS)], 1) for j in (0, 1))
        cell, near = np.empty(where.shape, int), np.empty(where.shape)
        for i in range(0, len(values), at_once):
            some = slice(i, i + at_once)
            v = values[some, None]
            gap = np.maximum(np.maximum(low - v, v - high), 0) / sigma
            upto = np.cumsum(size * np.exp(-(gap**2) / 2), axis=1)
            drawn = where[some] * upto[:, -1:]
            for m in range(PROPOSALS):
                cell[some, m] = (upto <= drawn[:, m : m + 1]).sum(axis=1)
            cell[some] = np.minimum(cell[some], len(size) - 1)
            near[some] = np.take_along_axis(gap, cell[some], 1)
        place = (first[cell] + np.floor(inside * size[cell])).astype(np.int64)
        far = np.maximum(values[:, None] - low[cell], high[cell] - values[:, None]) / sigma
        lucks = luck.flatten().to_numpy().reshape(where.shape) % (1 << 40) / float(1 << 40)
        sure = lucks < np.exp(-(far * far - near * near) / 2) * (1 - SLACK)
        upto = np.where(sure.any(axis=1), sure.argmax(axis=1) + 1, PROPOSALS)
        kept = (np.arange(PROPOSALS)[None, :] >= upto[:, None]) == late
        ends = pa.array(np.concatenate([[0], np.cumsum(kept.sum(axis=1))]), pa.int32())
        m = np.broadcast_to(np.arange(PROPOSALS, dtype=np.int32), where.shape)
        return pa.ListArray.from_arrays(ends, pa.StructArray.from_arrays([pa.array(x[kept]) for x in (m, place, near, lucks)], DRAWN))

    kind = "array<struct<_m:int,_place:long,_gap:double,_luck:double>>"

    @F.arrow_udf(kind)
    def early(y: pa.Array, h: pa.Array, luck: pa.Array) -> pa.Array:
        return run(y, h, luck, False)

    @F.arrow_udf(kind)
    def later(y: pa.Array, h: pa.Array, luck: pa.Array) -> pa.Array:
        return run(y, h, luck, True)

    return early, later


def _drawn(waiting: DataFrame, propose, key: str, seed: int, k: int, late: bool) -> DataFrame:
    """``key, _y, _d``: the proposals of round ``k`` up to the first that passes whatever label it meets in its cell;
    ``late``: those after it, which are needed where it met a row of its own key."""
    luck = F.array(*[F.xxhash64(F.lit(seed), F.lit(k), F.lit(m), key, F.lit("luck")) for m in range(PROPOSALS)])
    return waiting.select(key, "_y", propose[late]("_y", F.xxhash64(F.lit(seed), F.lit(k), key), luck).alias("_d"))


def cmixup_partners(df: DataFrame, key: str, label: str, seed: int = 0) -> DataFrame:
    """Q9: C-MixUp partners ``(key, partner, label_gap)``: row ``j`` for row ``i`` with probability proportional to
    ``exp(-(y_i - y_j)^2 / 2 sigma^2)``, sigma half the sample deviation of the label, never itself.

    Rows are numbered in label cells of a quarter sigma.  A row proposes places in cells drawn by their size and
    the largest weight that they can have for it, and takes the first proposal that passes the rejection test for its own
    weight; rows without one go on to the next round.  Draws are keyed hashes, so they do not depend on the
    partitioning.  A proposal passes with a probability of about a half or more (the weight of a cell varies little
    over a quarter sigma), so the rounds are few.  A proposal that passes even at the far end of its cell ends a row's
    proposals, so about one or two of a row are joined, with the outcome of all of them.  The only row of a table has
    no partner; rows without a label take no part.  ``key`` is unique.
    """
    rows = df.where(F.col(label).isNotNull()).select(key, F.col(label).cast("double").alias("_y"))
    deviation = rows.agg(F.stddev_samp("_y")).first()[0]
    sigma = deviation / 2 if deviation else 1.0
    rows = global_row_number(rows.withColumn("_c", F.floor(F.col("_y") / (sigma / CELLS_PER_SIGMA))), ["_c", key], "_rn")
    rows = cut_lineage(rows)
    cells = rows.groupBy("_c").agg(F.min("_y").alias("lo"), F.max("_y").alias("hi"), F.count(F.lit(1)).alias("n"),
                                   F.min("_rn").alias("first")).orderBy("_c").collect()  # a row per cell: range over sigma
    if sum(c["n"] for c in cells) < 2:
        return rows.limit(0).select(key, F.col(key).alias("partner"), F.lit(0.0).alias("label_gap"))
    propose, found, waiting = _proposals(cells, sigma), None, rows.select(key, "_y")
    others = rows.select(F.col("_rn").alias("_place"), F.col(key).alias("partner"), F.col("_y").alias("_py"))
    def chance(distance):
        return F.exp(-(distance * distance - F.col("_gap") * F.col("_gap")) / 2)

    def accepted(proposals: DataFrame) -> DataFrame:
        """The first proposal of every key that passes."""
        met = proposals.select(key, "_y", F.inline("_d")).join(others, "_place")
        passed = met.where((F.col("_luck") < chance((F.col("_y") - F.col("_py")) / sigma)) & (F.col(key) != F.col("partner")))
        return passed.groupBy(key).agg(F.min_by(F.struct("partner", F.abs(F.col("_y") - F.col("_py")).alias("label_gap")), "_m").alias("_p"))

    for k, late in ((k, late) for k in range(ROUNDS) for late in (False, True)):
        drawn = _drawn(waiting, propose, key, seed, k, late)
        passed = cut_lineage(accepted(drawn).select(key, "_p.*"))
        found = passed if found is None else found.unionByName(passed)
        waiting = cut_lineage(waiting.join(passed.select(key), key, "left_anti"))
        if not waiting.limit(1).count():
            return found
    raise RuntimeError(f"no partner within {ROUNDS} rounds")


def class_weights(df: DataFrame, label: str) -> DataFrame:
    """Q10: positive-class weight ``(n - n+) / n+``; null without positives."""
    return df.agg(F.try_divide((F.count(F.lit(1)) - F.sum(label)).cast("double"), F.sum(label).cast("double")).alias("pos_weight"))


def rebalance(df: DataFrame, key: str, label: str, mode: str = "under", seed: int = 0) -> DataFrame:
    """Q10: equalise two classes by keyed-hash undersampling of the majority or by
    replicating minority rows (whole copies, then a hash-chosen remainder)."""
    counts = {r[0]: r[1] for r in df.groupBy(label).count().collect()}  # one row per class
    (maj, n_maj), (mino, n_min) = sorted(counts.items(), key=lambda kv: -kv[1])[:2]
    u = F.pmod(F.xxhash64(F.lit(seed), F.col(key)), F.lit(1_000_000)) / 1_000_000.0
    if mode == "under":
        return df.where((F.col(label) != maj) | (u < n_min / n_maj))
    ratio = n_maj / n_min
    whole, rest = int(ratio), ratio - int(ratio)
    reps = F.when(F.col(label) == mino, F.lit(whole) + (u < rest).cast("int")).otherwise(F.lit(1))
    return df.withColumn("_rep", F.explode(F.sequence(F.lit(1), reps))).drop("_rep")
