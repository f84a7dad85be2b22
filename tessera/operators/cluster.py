"""Clustering (K1-K6): assignments are projections against broadcast centroids
(k x d numbers), updates are one grouped aggregate per iteration."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.session import cut_lineage


def _sqdist(vec: str, centre: list[float]) -> Column:
    return F.aggregate(F.arrays_zip(F.col(vec).alias("x"), F.array(*[F.lit(float(c)) for c in centre]).alias("c")),
                       F.lit(0.0), lambda acc, e: acc + (e["x"] - e["c"]) * (e["x"] - e["c"]))


def assign(df: DataFrame, vec: str, centroids: list[list[float]], out: str = "cluster") -> DataFrame:
    """Nearest centroid (squared Euclidean); ties -> lowest index (like ``argmin``)."""
    cand = [F.struct(_sqdist(vec, c).alias("d"), F.lit(i).alias("i")) for i, c in enumerate(centroids)]
    best = F.least(*cand) if len(cand) > 1 else cand[0]
    return df.withColumn(out, best["i"])


def _means(df: DataFrame, vec: str, cluster: str) -> dict:
    per = df.select(cluster, F.posexplode(vec).alias("j", "x")).groupBy(cluster, "j").agg(F.avg("x").alias("m"))
    out: dict = {}
    for r in per.collect():  # k x d numbers
        out.setdefault(r[cluster], {})[r["j"]] = r["m"]
    return {c: [m[j] for j in sorted(m)] for c, m in out.items()}


def kmeans_lloyd(df: DataFrame, vec: str, centroids: list[list[float]], iters: int = 10) -> list[list[float]]:
    """K1: Lloyd iterations from given centroids (an empty cluster keeps its centroid)."""
    data = cut_lineage(df.select(F.col(vec).cast("array<double>").alias(vec)))
    cents = [list(map(float, c)) for c in centroids]
    for _ in range(iters):
        means = _means(assign(data, vec, cents), vec, "cluster")
        new = [means.get(i, c) for i, c in enumerate(cents)]
        if new == cents:
            break
        cents = new
    return cents


def kmeans(df: DataFrame, vec: str, k: int, seed: int = 1, max_iter: int = 300):
    """K2: random-init k-means to convergence (MLlib, k-means|| init)."""
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.functions import array_to_vector

    d = df.withColumn("__f", array_to_vector(F.col(vec).cast("array<double>")))
    return KMeans(featuresCol="__f", k=k, seed=seed, maxIter=max_iter, tol=0.0).fit(d)


def seeded_kmeans(df: DataFrame, vec: str, label: str, iters: int = 10) -> tuple[list[list[float]], DataFrame]:
    """K3: standardise each dimension (population std), seed centroids with the per-label
    means of the labelled rows, then Lloyd; returns centroids and assignments."""
    d = df.select("*", F.posexplode(F.col(vec).cast("array<double>")).alias("_j", "_x"))
    st = d.groupBy("_j").agg(F.avg("_x").alias("m"), F.stddev_pop("_x").alias("s")).collect()  # d rows
    st = sorted(st, key=lambda r: r["_j"])
    means = F.array(*[F.lit(float(r["m"])) for r in st])
    stds = F.array(*[F.lit(float(r["s"]) or 1.0) for r in st])
    z = df.withColumn("_z", F.zip_with(F.zip_with(F.col(vec).cast("array<double>"), means, lambda a, b: a - b), stds,
                                       lambda a, b: a / b))
    seeds = _means(z.where(F.col(label).isNotNull()).withColumn("_c", F.col(label)), "_z", "_c")
    labels = sorted(seeds)
    cents = kmeans_lloyd(z, "_z", [seeds[lab] for lab in labels], iters)
    return cents, assign(z, "_z", cents).withColumn("cluster_label", F.element_at(
        F.array(*[F.lit(lab) for lab in labels]), F.col("cluster") + 1)).drop("_z")


def spread(df: DataFrame, vec: str, cluster: str) -> DataFrame:
    """K4: per-cluster SSE around the cluster mean, plus the reference's sum of sqrt(SSE)."""
    d = df.select(cluster, F.posexplode(F.col(vec).cast("array<double>")).alias("j", "x"))
    per = d.groupBy(cluster, "j").agg((F.sum(F.col("x") * F.col("x")) - F.sum("x") * F.sum("x") / F.count(F.lit(1)))
                                      .alias("sse_j"))
    sse = per.groupBy(cluster).agg(F.sum("sse_j").alias("sse"))
    return sse.agg(F.sum("sse").alias("sse"), F.sum(F.sqrt(F.greatest("sse", F.lit(0.0)))).alias("sum_sqrt_sse"))


def elbow(df: DataFrame, vec: str, ks: list[int], seed: int = 1) -> DataFrame:
    """K4: spread for each k (MLlib k-means) and the elbow = k after the largest drop of sum sqrt(SSE)."""
    rows = []
    for k in ks:
        m = kmeans(df, vec, k, seed)
        from pyspark.ml.functions import array_to_vector

        pred = m.transform(df.withColumn("__f", array_to_vector(F.col(vec).cast("array<double>"))))
        s = spread(pred, vec, "prediction").first()
        rows.append((k, float(s["sse"]), float(s["sum_sqrt_sse"])))
    drops = [rows[i - 1][2] - rows[i][2] for i in range(1, len(rows))]
    best = rows[1 + max(range(len(drops)), key=lambda i: drops[i])][0] if drops else rows[0][0]
    return df.sparkSession.createDataFrame([(k, s, q, k == best) for k, s, q in rows],
                                           "k int, sse double, sum_sqrt_sse double, is_elbow boolean")


def silhouette(df: DataFrame, vec: str, cluster: str, key: str) -> DataFrame:
    """K5: exact silhouette for squared Euclidean distance in O(n k).

    For a point x and cluster C, ``sum_{y in C} |x-y|^2 = n_C |x|^2 - 2 x.S_C + Q_C``
    with ``S_C`` the vector sum and ``Q_C`` the sum of squared norms; ``a`` averages
    over the other members of its own cluster, ``b`` is the smallest mean over
    another cluster, ``s = (b-a)/max(a,b)``, 0 for a singleton.  Only the k
    cluster sums are broadcast (the exact Euclidean form needs all pairs and is
    not built).
    """
    d = df.select(key, cluster, F.col(vec).cast("array<double>").alias("_v"))
    sums = d.select(cluster, F.posexplode("_v").alias("j", "x")).groupBy(cluster, "j").agg(F.sum("x").alias("s"))
    q = d.groupBy(cluster).agg(F.count(F.lit(1)).alias("n"),
                               F.sum(F.aggregate("_v", F.lit(0.0), lambda a, x: a + x * x)).alias("q"))
    rows = {r[cluster]: {"n": r["n"], "q": r["q"], "s": {}} for r in q.collect()}  # k rows
    for r in sums.collect():  # k x d numbers
        rows[r[cluster]]["s"][r["j"]] = r["s"]
    cl = sorted(rows)
    if len(cl) < 2:
        return d.select(key, F.lit(0.0).alias("silhouette"))
    norm = F.aggregate("_v", F.lit(0.0), lambda a, x: a + x * x)
    total = {}
    for c in cl:
        s = [rows[c]["s"][j] for j in sorted(rows[c]["s"])]
        dot = F.aggregate(F.arrays_zip(F.col("_v").alias("x"), F.array(*[F.lit(float(v)) for v in s]).alias("s")),
                          F.lit(0.0), lambda a, e: a + e["x"] * e["s"])
        total[c] = F.lit(float(rows[c]["n"])) * norm - 2 * dot + F.lit(float(rows[c]["q"]))
    own_n = F.element_at(F.array(*[F.lit(float(rows[c]["n"])) for c in cl]),
                         F.array_position(F.array(*[F.lit(c) for c in cl]), F.col(cluster)).cast("int"))
    a = F.coalesce(*[F.when(F.col(cluster) == c, total[c]) for c in cl]) / (own_n - 1)
    b = F.least(*[F.when(F.col(cluster) != c, total[c] / float(rows[c]["n"])) for c in cl])
    s = F.when(own_n <= 1, F.lit(0.0)).otherwise((b - a) / F.greatest(a, b))
    return d.select(key, cluster, s.alias("silhouette"))


def ari_nmi(df: DataFrame, a: str, b: str) -> DataFrame:
    """K6: adjusted Rand index and normalised mutual information (arithmetic mean of
    entropies) from the contingency table (one aggregate)."""
    ct = df.groupBy(a, b).agg(F.count(F.lit(1)).alias("n"))
    ra = ct.groupBy(a).agg(F.sum("n").alias("n"))
    rb = ct.groupBy(b).agg(F.sum("n").alias("n"))

    def comb2(c):
        return c * (c - 1) / 2.0

    n = df.count()
    s_ct = ct.agg(F.sum(comb2(F.col("n")))).first()[0]
    s_a = ra.agg(F.sum(comb2(F.col("n")))).first()[0]
    s_b = rb.agg(F.sum(comb2(F.col("n")))).first()[0]
    exp = s_a * s_b / (n * (n - 1) / 2.0)
    ari = (s_ct - exp) / (0.5 * (s_a + s_b) - exp) if (0.5 * (s_a + s_b) - exp) != 0 else 1.0
    pa = {r[0]: r[1] for r in ra.collect()}  # one row per label
    pb = {r[0]: r[1] for r in rb.collect()}
    ha = -sum(v / n * math.log(v / n) for v in pa.values())
    hb = -sum(v / n * math.log(v / n) for v in pb.values())
    mi = ct.join(ra.withColumnRenamed("n", "na"), a).join(rb.withColumnRenamed("n", "nb"), b).agg(
        F.sum(F.col("n") / n * F.log(F.col("n") * n / (F.col("na") * F.col("nb"))))).first()[0]
    nmi = mi / ((ha + hb) / 2) if (ha + hb) > 0 else 1.0
    return df.sparkSession.createDataFrame([(float(ari), float(nmi))], "ari double, nmi double")
