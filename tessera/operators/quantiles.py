"""Exact percentiles without a per-group buffer.

Values are counted per ``(group, value)`` (map-side combined), running counts
along the global ``(group, value)`` order give every value its ranks within the
group, and only the one or two rows that hold the wanted ranks are kept.  A
group with a third of all rows is spread over as many partitions as its share
of distinct values.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.operators.ranking import global_cumsum


def exact_percentiles(df: DataFrame, keys: list[str], col: str, ps: dict[str, float]) -> DataFrame:
    """One row per group that has a non-null ``col``: the keys and, per ``name -> p`` of ``ps``, the
    percentile linearly interpolated between the neighbouring ranks (as ``percentile``)."""
    grouped = [F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)] or [F.lit(0).alias("_k0")]
    names = [f"_k{i}" for i in range(len(grouped))]
    counts = (
        df.select(*grouped, F.col(col).cast("double").alias("_v")).where("_v is not null")
        .groupBy(*names, "_v").agg(F.count(F.lit(1)).alias("_n"))
    )
    placed = global_cumsum(counts, [*names, "_v"], ["_n"]).withColumn("_from", F.col("_n_cum") - F.col("_n"))
    totals = placed.groupBy(*names).agg(F.sum("_n").alias("_size"), F.min("_from").alias("_start"))
    totals = totals.select(*[F.col(k).alias(f"_t{k}") for k in names], "_size", "_start")
    on = None
    for k in names:
        part = F.col(k).eqNullSafe(F.col(f"_t{k}"))
        on = part if on is None else on & part
    ranks = placed.join(totals, on)
    first, after = F.col("_from") - F.col("_start"), F.col("_n_cum") - F.col("_start")

    def holds(rank):
        return (first <= rank) & (rank < after)

    wanted = {name: F.lit(float(p)) * (F.col("_size") - 1) for name, p in ps.items()}
    hit = None
    for r in wanted.values():
        part = holds(F.floor(r)) | holds(F.ceil(r))
        hit = part if hit is None else hit | part
    kept = ranks.where(hit)
    out = []
    for name, r in wanted.items():
        low = F.max(F.when(holds(F.floor(r)), F.col("_v")))
        high = F.max(F.when(holds(F.ceil(r)), F.col("_v")))
        share = F.max(r - F.floor(r))
        out.append(F.when(share == 0, low).otherwise((1 - share) * low + share * high).alias(name))
    found = kept.groupBy(*names).agg(*out)
    return found.select(*[F.col(f"_k{i}").alias(k) for i, k in enumerate(keys)], *ps)
