"""Aggregation, ordering and top-k.

Every grouped aggregate here is algebraic (count/sum/min/max/avg/variance), so
Spark combines it map-side before the shuffle: a key holding a third of all
rows costs one partial row per task, not a hot reducer.  Exact medians use
``percentile`` which is holistic; see ``user_profile``.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.operators.quantiles import exact_percentiles

# Garment parts excluded from the main-garment ranking (D2 default).
GARMENT_PARTS = ("collar", "pocket", "sleeve", "zipper", "button", "buckle")


def class_balance(df: DataFrame, label: str) -> DataFrame:
    """Count and percentage of rows per class."""
    total = df.count()
    return df.groupBy(label).agg(F.count(F.lit(1)).alias("n")).withColumn(
        "pct", F.col("n") * 100.0 / F.lit(total))


def category_stats(df: DataFrame, objects_col: str, parts=GARMENT_PARTS, k: int = 10,
                   category: str = "category", value: str = "area") -> DataFrame:
    """Per category count, mean, population std and ``score = count * mean``;
    top ``k`` by score among categories that are not parts."""
    o = df.select(F.explode(F.arrays_zip(F.col(f"{objects_col}.{category}").alias("c"),
                                         F.col(f"{objects_col}.{value}").alias("v"))).alias("o"))
    stats = o.groupBy(F.col("o.c").alias("category")).agg(
        F.count(F.lit(1)).alias("count"), F.avg("o.v").alias("avg_value"), F.stddev_pop("o.v").alias("std_value"))
    stats = stats.withColumn("is_part", F.lower("category").isin([p.lower() for p in parts]))
    stats = stats.withColumn("score", F.col("count") * F.col("avg_value"))
    return stats.where(~F.col("is_part")).orderBy(F.desc("score"), "category").limit(k)


def rebuild_state(events: DataFrame, key: str = "product_id", ts: str = "ts", id_col: str = "id",
                  action: str = "action", qty: str = "qty_delta", price: str = "unit_price") -> DataFrame:
    """D3: current state per key from an event log.

    stock = sum of deltas; latest_price = last non-null price by ``(ts, id)``;
    total_sales = sum of ``-qty_delta * unit_price`` over sale events.
    """
    has_price = F.col(price).isNotNull()
    is_sale = F.col(action) == "sale"
    return events.groupBy(key).agg(
        F.sum(qty).alias("stock"),
        F.max_by(F.col(price), F.when(has_price, F.struct(ts, id_col))).alias("latest_price"),
        F.sum(F.when(is_sale, -F.col(qty) * F.col(price))).alias("total_sales"),
        F.count_if(is_sale).alias("n_sales"),
    )


def sales_by(events: DataFrame, attr: str, k: int = 1, action: str = "action", qty: str = "qty_delta",
             price: str = "unit_price") -> DataFrame:
    """Revenue per attribute over sale events with the sign fixed, top ``k``."""
    return (
        events.where(F.col(action) == "sale")
        .groupBy(attr).agg(F.sum(-F.col(qty) * F.col(price)).alias("revenue"))
        .orderBy(F.desc("revenue"), attr).limit(k)
    )


def period_compare(df: DataFrame, date: str, group: str, value: str, quarter: int, years: list[int]) -> DataFrame:
    """One quarter, several years side by side per group (explicit pivot values: no extra pass)."""
    return (
        df.where((F.quarter(date) == quarter) & F.year(date).isin(years))
        .withColumn("_year", F.year(date))
        .groupBy(group).pivot("_year", years).agg(F.sum(value))
    )


def token_counts(tokens: DataFrame, token: str = "token") -> DataFrame:
    """Frequency of every token."""
    return tokens.groupBy(token).agg(F.count(F.lit(1)).alias("n"))


def vocab_topk(counts: DataFrame, k: int, token: str = "token") -> DataFrame:
    """``most_common(k)`` with a deterministic tie-break (count desc, token asc)."""
    return counts.orderBy(F.desc("n"), token).limit(k)


def vocab_mincount(counts: DataFrame, min_count: int) -> DataFrame:
    """Every token seen at least ``min_count`` times."""
    return counts.where(F.col("n") >= min_count)


def cov_matrix(df: DataFrame, cols: list[str]) -> DataFrame:
    """Sample covariance matrix (n-1) in long form ``(row, col, cov)``, one pass."""
    aggs = []
    for a in cols:
        for b in cols:
            aggs.append(F.covar_samp(a, b).alias(f"{a}|{b}"))
    wide = df.agg(*aggs)
    long = wide.unpivot([], wide.columns, "pair", "cov")
    return long.select(F.split("pair", r"\|")[0].alias("row"), F.split("pair", r"\|")[1].alias("col"), "cov")


def correlate(df: DataFrame, cols: list[str]) -> DataFrame:
    """Pearson correlation of every column pair, long form."""
    wide = df.agg(*[F.corr(a, b).alias(f"{a}|{b}") for a, b in combinations(cols, 2)])
    long = wide.unpivot([], wide.columns, "pair", "corr")
    return long.select(F.split("pair", r"\|")[0].alias("a"), F.split("pair", r"\|")[1].alias("b"), "corr")


def feature_variances(df: DataFrame, cols: list[str]) -> DataFrame:
    """Population variance per column, long form (input of the low-variance filter)."""
    wide = df.agg(*[F.var_pop(c).alias(c) for c in cols])
    return wide.unpivot([], cols, "feature", "variance")


def drop_low_variance(df: DataFrame, cols: list[str], threshold: float) -> DataFrame:
    """Keep only feature columns whose population variance exceeds ``threshold``."""
    v = feature_variances(df, cols).collect()  # one row per feature column
    keep = {r["feature"] for r in v if r["variance"] is not None and r["variance"] > threshold}
    return df.select(*[c for c in df.columns if c not in cols or c in keep])


def anova_f(df: DataFrame, cols: list[str], label: str) -> DataFrame:
    """One-way ANOVA F statistic of each feature against a class label.

    ``F = (SSB / (k-1)) / (SSW / (n-k))`` from per-class count/sum/sum of squares
    (one partial aggregate) - the score behind k-best selection.
    """
    per = df.groupBy(label).agg(
        F.count(F.lit(1)).alias("_n"),
        *[F.sum(c).alias(f"s_{c}") for c in cols],
        *[F.sum(F.col(c) * F.col(c)).alias(f"q_{c}") for c in cols])
    tot = per.agg(F.sum("_n").alias("n"), F.count(F.lit(1)).alias("k"),
                  *[F.sum(f"s_{c}").alias(f"s_{c}") for c in cols],
                  *[F.sum(f"q_{c}").alias(f"q_{c}") for c in cols],
                  *[F.sum(F.col(f"s_{c}") * F.col(f"s_{c}") / F.col("_n")).alias(f"b_{c}") for c in cols])
    n, k = F.col("n"), F.col("k")
    stats = tot.select(*[
        (((F.col(f"b_{c}") - F.col(f"s_{c}") * F.col(f"s_{c}") / n) / (k - 1))
         / ((F.col(f"q_{c}") - F.col(f"b_{c}")) / (n - k))).alias(c) for c in cols])
    return stats.unpivot([], cols, "feature", "f_stat")


def k_best(df: DataFrame, cols: list[str], label: str, k: int) -> DataFrame:
    """The ``k`` features with the largest ANOVA F."""
    return anova_f(df, cols, label).orderBy(F.desc("f_stat"), "feature").limit(k)


def user_profile(df: DataFrame, user: str, amount: str, ts: str) -> DataFrame:
    """Per user mean / exact median / sample std of the amount, event count and events per active day.

    The median comes from distributed ranks (:mod:`tessera.operators.quantiles`), the
    days from one row per user and day, so no task holds a user's values.  Amounts are
    summed as decimals (12 places, below 1e16), so the mean does not depend on the partitioning.
    """
    days = df.groupBy(F.col(user), F.to_date(ts).alias("_day")).agg(
        F.count(F.lit(1)).alias("_n"), F.count(amount).alias("_m"), F.sum(F.col(amount).cast("decimal(28,12)")).alias("_s"),
        F.var_pop(amount).alias("_v"), F.avg(amount).alias("_a"))
    totals = days.groupBy(user).agg(F.sum("_s").alias("_sum"), F.sum("_m").alias("_cnt"), F.sum("_n").alias("n_events"),
                                    F.count("_day").alias("_days"))
    mean = totals.select(F.col(user).alias("_u"), F.try_divide(F.col("_sum").cast("double"), "_cnt").alias("mean_amount"), "_cnt", "n_events", "_days")
    # spread about the overall mean, day by day (exact pooling of the days' variances)
    spread = days.join(mean.select("_u", "mean_amount"), F.col(user).eqNullSafe(F.col("_u"))).groupBy("_u").agg(
        F.sum(F.col("_m") * (F.col("_v") + (F.col("_a") - F.col("mean_amount")) * (F.col("_a") - F.col("mean_amount")))).alias("_ss"))
    median = exact_percentiles(df, [user], amount, {"median_amount": 0.5}).withColumnRenamed(user, "_u2")
    found = mean.join(spread.withColumnRenamed("_u", "_u1"), F.col("_u").eqNullSafe(F.col("_u1")), "left")
    found = found.join(median, F.col("_u").eqNullSafe(F.col("_u2")), "left")
    return found.select(
        F.col("_u").alias(user), "mean_amount", "median_amount",
        F.sqrt(F.try_divide(F.col("_ss"), F.col("_cnt") - 1)).alias("std_amount"), "n_events",
        F.try_divide("n_events", "_days").alias("events_per_day"),
    )


URL_PATTERN = r"(?i)https?://[^\s\]\)>\}]+"


def domain_share(df: DataFrame, text: str, domains: list[str], min_ratio: float = 0.4) -> DataFrame:
    """Share of extracted URLs whose host contains a preferred domain; pass if >= ``min_ratio``.

    Host = third ``/``-separated field of the URL; no URL -> fail with ratio 0.
    """
    urls = F.regexp_extract_all(F.col(text), F.lit(URL_PATTERN), 0)
    pref = F.filter(urls, lambda u: F.exists(F.array(*[F.lit(d) for d in domains]),
                                             lambda d: F.instr(F.split(u, "/")[2], d) > 0))
    n = F.size(urls)
    ratio = F.when(n > 0, F.size(pref) / n).otherwise(F.lit(0.0))
    return df.select("*", n.alias("n_urls"), F.size(pref).alias("n_preferred"), ratio.alias("ratio"),
                     ((n > 0) & (ratio >= min_ratio)).alias("passed"))


def top_k(df: DataFrame, by: list, k: int) -> DataFrame:
    """Sort then head; Spark plans ``TakeOrderedAndProject`` (per-task top-k, no full sort)."""
    return df.orderBy(*by).limit(k)


def histogram(df: DataFrame, col: str, bins: int = 20) -> DataFrame:
    """Equal-width histogram between min and max (the max falls in the last bin).

    Two passes: min/max (one row), then one partial-aggregated count per bin.
    """
    mm = df.agg(F.min(col).alias("lo"), F.max(col).alias("hi")).first()
    lo, hi = float(mm["lo"]), float(mm["hi"])
    width = (hi - lo) / bins if hi > lo else 1.0
    b = F.least(F.floor((F.col(col) - F.lit(lo)) / F.lit(width)), F.lit(bins - 1)).cast("int")
    return (
        df.where(F.col(col).isNotNull()).groupBy(b.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
        .withColumn("lo", F.lit(lo) + F.col("bin") * F.lit(width))
        .withColumn("hi", F.lit(lo) + (F.col("bin") + 1) * F.lit(width))
    )
