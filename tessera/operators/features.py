"""Feature engineering.

Statistics (means, std, min/max, category lists) are computed with one
aggregate and applied as literals or through a join with a table whose size
is bounded by the number of columns or categories - never by the row count.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def one_hot(df: DataFrame, cols: list[str], categories: dict | None = None, drop: bool = True, most: int = 1000) -> DataFrame:
    """G1: integer 0/1 indicator per (column, value) in sorted value order; null -> all zeros.

    One column per distinct value, so the values are gathered on the driver: for
    columns of at most ``most`` categories, an error beyond.  :func:`one_hot_sparse` is the path for many.
    """
    categories = dict(categories or {})
    out = df
    for c in cols:
        if c not in categories:
            found = df.select(c).where(F.col(c).isNotNull()).distinct().limit(most + 1).collect()
            if len(found) > most:
                raise ValueError(f"{c} has more than {most} categories; use one_hot_sparse")
            categories[c] = sorted(r[0] for r in found)
        out = out.select("*", *[F.coalesce((F.col(c) == F.lit(v)).cast("int"), F.lit(0)).alias(f"{c}_{v}")
                                for v in categories[c]])
        if drop:
            out = out.drop(c)
    return out


def one_hot_sparse(df: DataFrame, cols: list[str], out: str = "onehot") -> DataFrame:
    """G1 for any number of categories: ``out`` holds the indices of the row's indicators.

    Each ``(column, value)`` gets a dense index in (column, sorted value) order by
    a distributed row number; rows meet their index by a join, null values have none.
    """
    from tessera.operators.ranking import global_row_number

    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("c"), F.col(c).cast("string").alias("v")) for c in cols]))
    index = df.select(pairs.alias("p")).select("p.c", "p.v").where("v is not null").distinct()
    index = global_row_number(index, ["c", "v"], "i")
    res = df
    for c in cols:
        own = index.where(F.col("c") == c).select(F.col("v").alias(f"_v_{c}"), (F.col("i") - 1).alias(f"_i_{c}"))
        res = res.join(own, F.col(c).cast("string") == F.col(f"_v_{c}"), "left")
    found = F.array_compact(F.array(*[F.col(f"_i_{c}") for c in cols]))
    return res.select(*[c for c in df.columns if c not in cols], found.alias(out))


def graph_features(tx: DataFrame, key: str, cat_cols: list[str], amount: str, label: str) -> tuple[DataFrame, DataFrame]:
    """``(features, tags)``: key first, one-hot categoricals, ``log10(amount)``; tags = key + label."""
    feats = one_hot(tx.select(key, *cat_cols, amount), cat_cols).withColumn(amount, F.log10(amount))
    return feats, tx.select(key, label)


def keep_top_categories(df: DataFrame, col: str, n: int, other: str = "Other") -> DataFrame:
    """The ``n`` most frequent values (ties by value) stay, every other value becomes ``other``."""
    top = df.groupBy(col).count().orderBy(F.desc("count"), col).limit(n).select(col, F.lit(1).alias("_keep"))
    j = df.join(F.broadcast(top), col, "left")  # at most n rows
    return j.withColumn(col, F.when(F.col("_keep") == 1, F.col(col)).otherwise(F.lit(other))).drop("_keep")


def dict_vectorize(df: DataFrame, cols: list[str], out: str = "features"):
    """``name=value`` one-hot of categorical columns as one vector (fitted pipeline model)."""
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler

    idx = [StringIndexer(inputCol=c, outputCol=f"{c}__idx", handleInvalid="keep", stringOrderType="alphabetAsc")
           for c in cols]
    ohe = OneHotEncoder(inputCols=[f"{c}__idx" for c in cols], outputCols=[f"{c}__ohe" for c in cols], dropLast=False)
    va = VectorAssembler(inputCols=[f"{c}__ohe" for c in cols], outputCol=out)
    return Pipeline(stages=[*idx, ohe, va]).fit(df)


def murmur3(data: bytes, seed: int = 0) -> int:
    """MurmurHash3 (x86, 32 bits) as a signed integer."""
    mask = 0xFFFFFFFF
    h, whole = seed, len(data) // 4 * 4

    def scrambled(k: int) -> int:
        k = k * 0xCC9E2D51 & mask
        return ((k << 15 | k >> 17) & mask) * 0x1B873593 & mask

    for at in range(0, whole, 4):
        h ^= scrambled(int.from_bytes(data[at : at + 4], "little"))
        h = ((h << 13 | h >> 19) & mask) * 5 + 0xE6546B64 & mask
    if data[whole:]:
        h ^= scrambled(int.from_bytes(data[whole:], "little"))
    h ^= len(data)
    for shift, factor in ((16, 0x85EBCA6B), (13, 0xC2B2AE35)):
        h = (h ^ h >> shift) * factor & mask
    h ^= h >> 16
    return h - (1 << 32) if h >> 31 else h


def hash_features(df: DataFrame, cols: list[str], n: int, out: str = "features") -> DataFrame:
    """Signed hashing trick into ``n`` buckets, as a map ``bucket -> value``.

    A text column hashes ``name=value`` with the value 1, a numeric one its name with its own value.  The bucket is
    the hash's magnitude modulo ``n``, its sign is that of the value, so collisions cancel on average; values of
    one bucket add up.  Nulls and zeros leave no entry.
    """
    def place(name: str) -> tuple[int, float]:
        h = murmur3(name.encode())
        return abs(h) % n, 1.0 if h >= 0 else -1.0

    @F.pandas_udf("struct<b:int,v:double>")
    def placed(names: pd.Series) -> pd.DataFrame:
        known = {x: place(x) for x in names.dropna().unique()}
        return pd.DataFrame([known.get(x, (None, None)) for x in names], columns=["b", "v"]).astype({"b": "Int32", "v": "float64"})

    entries = []
    for c in cols:
        if dict(df.dtypes)[c] == "string":
            entries.append(placed(F.concat(F.lit(f"{c}="), F.col(c))))
        else:
            b, sign = place(c)
            entries.append(F.struct(F.lit(b).alias("b"), (F.col(c).cast("double") * sign).alias("v")))
    full = F.filter(F.array(*entries), lambda e: e["b"].isNotNull() & e["v"].isNotNull())
    work = df.withColumn("__e", full)
    buckets = F.array_sort(F.array_distinct(F.col("__e.b")))
    values = F.transform(buckets, lambda b: F.aggregate(F.filter("__e", lambda e: e["b"] == b), F.lit(0.0), lambda acc, e: acc + e["v"]))
    return work.withColumn(out, F.map_filter(F.map_from_arrays(buckets, values), lambda _, v: v != 0)).drop("__e")


def standardize(df: DataFrame, cols: list[str], eps: float = 0.0, fit: DataFrame | None = None) -> DataFrame:
    """``(x - mean) / (population std + eps)``; statistics from ``fit`` when given (one row).
    A constant column (divisor 0) gives null."""
    src = fit if fit is not None else df
    st = src.agg(*[F.avg(c).alias(f"m_{c}") for c in cols], *[F.stddev_pop(c).alias(f"s_{c}") for c in cols]).first()
    return df.select(*[c for c in df.columns if c not in cols],
                     *[F.try_divide(F.col(c) - F.lit(st[f"m_{c}"]), F.lit(st[f"s_{c}"]) + F.lit(float(eps))).alias(c)
                       for c in cols])


def minmax(df: DataFrame, cols: list[str], fit: DataFrame | None = None) -> DataFrame:
    """``(x - min) / (max - min)``; null for a constant column."""
    src = fit if fit is not None else df
    st = src.agg(*[F.min(c).alias(f"lo_{c}") for c in cols], *[F.max(c).alias(f"hi_{c}") for c in cols]).first()
    return df.select(*[c for c in df.columns if c not in cols],
                     *[F.try_divide((F.col(c) - F.lit(st[f"lo_{c}"])).cast("double"), (F.lit(st[f"hi_{c}"]) - F.lit(st[f"lo_{c}"])).cast("double")).alias(c)
                       for c in cols])


def fit_tabular(train: DataFrame, cat_cols: list[str], cont_cols: list[str], out: str = "features"):
    """Categorify (unknown kept) + exact median fill + normalise by mean and population deviation + assemble,
    fitted on ``train`` (the statistics are one row)."""
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import OneHotEncoder, SQLTransformer, StringIndexer, VectorAssembler

    from tessera.operators.quantiles import exact_percentiles

    filled = {}
    one = train.select(F.lit(0).alias("_one"), *[F.nanvl(F.col(c).cast("double"), F.lit(None)).alias(c) for c in cont_cols])
    for c in cont_cols:
        median = exact_percentiles(one.select("_one", c), ["_one"], c, {"median": 0.5}).first()
        m = median["median"] if median and median["median"] is not None else 0.0
        mean, deviation = one.select(F.coalesce(c, F.lit(m)).alias(c)).agg(F.avg(c), F.stddev_pop(c)).first()
        filled[c] = (m, mean, deviation or 1.0)  # a constant column becomes 0
    idx = [StringIndexer(inputCol=c, outputCol=f"{c}__idx", handleInvalid="keep") for c in cat_cols]
    ohe = OneHotEncoder(inputCols=[f"{c}__idx" for c in cat_cols], outputCols=[f"{c}__ohe" for c in cat_cols])
    scaled = ", ".join(f"(coalesce(nanvl(CAST(`{c}` AS DOUBLE), NULL), {m!r}D) - {mean!r}D) / {d!r}D AS `{c}__norm`" for c, (m, mean, d) in filled.items())
    norm = SQLTransformer(statement=f"SELECT *, {scaled} FROM __THIS__")
    va = VectorAssembler(inputCols=[f"{c}__ohe" for c in cat_cols] + [f"{c}__norm" for c in cont_cols], outputCol=out)
    return Pipeline(stages=[*idx, ohe, norm, va]).fit(train)


def assemble(df: DataFrame, cols: list[str], out: str = "features") -> DataFrame:
    """Vector assembly."""
    from pyspark.ml.feature import VectorAssembler

    return VectorAssembler(inputCols=cols, outputCol=out).transform(df)


# ------------------------------------------------------------------ moments

def _moments(df: DataFrame, vec: str, group: str | None = None) -> dict:
    """Count, sum and sum of outer products of an array column, per group.

    Each partition reduces its rows with NumPy (Arrow batches) to one row per
    group; the partials (``d*d`` numbers each) are summed by Spark.  Only
    ``groups x d x d`` numbers reach the driver.
    """
    src = df.select(F.col(group).alias("__g") if group else F.lit(0).alias("__g"), F.col(vec).alias("__v"))

    def partial(it):
        acc = {}
        for pdf in it:
            for g, part in pdf.groupby("__g"):
                x = np.stack(part["__v"].to_numpy()).astype(np.float64)
                n, s, q = acc.get(g, (0, 0.0, 0.0))
                acc[g] = (n + len(x), s + x.sum(0), q + x.T @ x)
        for g, (n, s, q) in acc.items():
            yield pd.DataFrame({"__g": [g], "n": [n], "s": [s.tolist()], "q": [q.ravel().tolist()]})

    parts = src.mapInPandas(partial, f"__g {src.schema['__g'].dataType.simpleString()}, n long, "
                                     "s array<double>, q array<double>")
    d_s = parts.select("__g", "n", F.posexplode("s").alias("i", "v")).groupBy("__g", "i").agg(F.sum("v").alias("v"))
    d_q = parts.select("__g", F.posexplode("q").alias("i", "v")).groupBy("__g", "i").agg(F.sum("v").alias("v"))
    d_n = parts.groupBy("__g").agg(F.sum("n").alias("n"))
    out = {}
    for r in d_n.collect():
        out[r["__g"]] = {"n": r["n"]}
    for name, t in (("s", d_s), ("q", d_q)):
        for r in t.collect():
            out[r["__g"]].setdefault(name, {})[r["i"]] = r["v"]
    res = {}
    for g, m in out.items():
        d = len(m["s"])
        s = np.array([m["s"][i] for i in range(d)])
        q = np.array([m["q"][i] for i in range(d * d)]).reshape(d, d)
        res[g] = (m["n"], s, q)
    return res


def pca_fit(df: DataFrame, vec: str, k: int) -> dict:
    """Mean, top-k eigenvectors of the sample covariance (n-1) and explained variance ratios."""
    n, s, q = _moments(df, vec)[0]
    mean = s / n
    cov = (q - n * np.outer(mean, mean)) / (n - 1)
    w, v = np.linalg.eigh(cov)
    order = np.argsort(w)[::-1]
    w, v = w[order], v[:, order]
    for j in range(v.shape[1]):  # deterministic sign: largest component positive
        if v[np.argmax(np.abs(v[:, j])), j] < 0:
            v[:, j] = -v[:, j]
    return {"mean": mean, "components": v[:, :k], "explained_variance": w[:k],
            "explained_variance_ratio": w[:k] / w.sum()}


def pca_project(df: DataFrame, vec: str, model: dict, out: str = "pca") -> DataFrame:
    """``(x - mean) . V_k`` (centred first: ``ml.PCA.transform`` does not centre)."""
    mean = [float(x) for x in model["mean"]]
    comps = model["components"]
    cols = []
    for j in range(comps.shape[1]):
        w = [float(x) for x in comps[:, j]]
        cols.append(F.aggregate(F.arrays_zip(F.col(vec).alias("x"), F.array(*[F.lit(m) for m in mean]).alias("m"),
                                             F.array(*[F.lit(x) for x in w]).alias("w")),
                                F.lit(0.0), lambda acc, e: acc + (e["x"] - e["m"]) * e["w"]))
    return df.withColumn(out, F.array(*cols))


def pca_inverse(df: DataFrame, proj: str, model: dict, out: str = "reconstructed") -> DataFrame:
    """``z . V_k^T + mean``."""
    mean, comps = model["mean"], model["components"]
    d = comps.shape[0]
    cols = []
    for i in range(d):
        w = [float(x) for x in comps[i, :]]
        cols.append(F.aggregate(F.arrays_zip(F.col(proj).alias("z"), F.array(*[F.lit(x) for x in w]).alias("w")),
                                F.lit(float(mean[i])), lambda acc, e: acc + e["z"] * e["w"]))
    return df.withColumn(out, F.array(*cols))


def fisher_lda(df: DataFrame, vec: str, label: str, k: int) -> dict:
    """Top eigenvectors of ``S_W^-1 S_B`` from per-class moments (one distributed pass)."""
    mom = _moments(df, vec, label)
    n_tot = sum(m[0] for m in mom.values())
    mu = sum(m[1] for m in mom.values()) / n_tot
    d = len(mu)
    sw, sb = np.zeros((d, d)), np.zeros((d, d))
    for n, s, q in mom.values():
        mc = s / n
        sw += q - n * np.outer(mc, mc)
        sb += n * np.outer(mc - mu, mc - mu)
    w, v = np.linalg.eig(np.linalg.pinv(sw) @ sb)
    order = np.argsort(w.real)[::-1]
    return {"eigenvalues": w.real[order][:k], "components": v.real[:, order][:, :k], "mean": mu}


def info_gain(df: DataFrame, attrs: list[str], target: str) -> DataFrame:
    """Information gain (base-2 entropy) of each categorical attribute; one unpivot + two aggregates."""
    long = df.select(target, *[F.col(a).cast("string").alias(a) for a in attrs]).unpivot(
        target, attrs, "attr", "value")
    c = long.groupBy("attr", "value", target).agg(F.count(F.lit(1)).alias("n"))
    per_value = c.groupBy("attr", "value").agg(
        F.sum("n").alias("nv"), F.collect_list(F.col("n")).alias("_ns"))  # one entry per target class
    ent_v = per_value.select("attr", "nv", F.aggregate(
        "_ns", F.lit(0.0), lambda acc, x: acc - (x / F.col("nv")) * F.log2(x / F.col("nv"))).alias("hv"))
    tot = df.count()
    parent = df.groupBy(target).agg(F.count(F.lit(1)).alias("n")).collect()  # one row per class
    h = -sum((r["n"] / tot) * math.log2(r["n"] / tot) for r in parent)
    return ent_v.groupBy("attr").agg((F.lit(h) - F.sum(F.col("nv") / tot * F.col("hv"))).alias("gain"))


def select_from_model(df: DataFrame, features: list[str], label: str, reg: float = 0.1) -> DataFrame:
    """Features with a non-zero Lasso coefficient, and tree importances of a random forest."""
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import LinearRegression, RandomForestRegressor

    d = VectorAssembler(inputCols=features, outputCol="__f").transform(df)
    lasso = LinearRegression(featuresCol="__f", labelCol=label, regParam=reg, elasticNetParam=1.0).fit(d)
    rf = RandomForestRegressor(featuresCol="__f", labelCol=label, numTrees=20, maxDepth=5, seed=1).fit(d)
    rows = [(f, float(c), float(i), abs(float(c)) > 0) for f, c, i in
            zip(features, lasso.coefficients.toArray(), rf.featureImportances.toArray())]
    return df.sparkSession.createDataFrame(rows, "feature string, lasso_coef double, importance double, kept boolean")
