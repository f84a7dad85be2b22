"""Supervised models whose core is distributed aggregation.

Split searches never loop over thresholds: one aggregate per (feature, value)
followed by running sums along the value order
(:func:`tessera.operators.ranking.global_cumsum`) scores every candidate
threshold of every feature in one pass.  Iterative fits checkpoint their state
into the shared checkpoint folder.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.operators.ranking import global_cumsum, global_row_number
from tessera.session import cut_lineage


# ------------------------------------------------------------------ split tables

def value_table(df: DataFrame, features: list[str], stats: dict) -> DataFrame:
    """Per (feature index ``fi``, value ``x``): the sums of ``stats`` at that value
    (``s_<k>``), inclusive running sums along ``x`` inside the feature (``c_<k>``)
    and feature totals (``t_<k>``)."""
    names = list(stats)
    rows = F.array(*[F.struct(F.lit(i).alias("fi"), F.col(f).cast("double").alias("x"),
                              *[stats[k].cast("double").alias(k) for k in names]) for i, f in enumerate(features)])
    long = df.select(F.inline(rows)).where(F.col("x").isNotNull())
    per = long.groupBy("fi", "x").agg(*[F.sum(k).alias(k) for k in names])
    cum = global_cumsum(per, ["fi", "x"], names, suffix="__cum")
    tots = sorted(per.groupBy("fi").agg(*[F.sum(k).alias(k) for k in names]).collect(), key=lambda r: r["fi"])
    spark = df.sparkSession
    acc = [0.0] * len(names)
    rows_t = []
    for r in tots:  # one row per feature
        rows_t.append((r["fi"], *acc, *[float(r[k]) for k in names]))
        acc = [a + float(r[k]) for a, k in zip(acc, names)]
    schema = "fi int, " + ", ".join([f"o_{k} double" for k in names] + [f"t_{k} double" for k in names])
    offs = spark.createDataFrame(rows_t, schema)
    out = cum.join(F.broadcast(offs), "fi")  # one row per feature
    return out.select("fi", "x", *[F.col(k).alias(f"s_{k}") for k in names],
                      *[(F.col(f"{k}__cum") - F.col(f"o_{k}")).alias(f"c_{k}") for k in names],
                      *[F.col(f"t_{k}") for k in names])


def with_next_value(vt: DataFrame) -> DataFrame:
    """Add ``x_next``: the next distinct value of the same feature (null at the end)."""
    numbered = global_row_number(vt, ["fi", "x"], "_rn")
    nxt = numbered.select((F.col("_rn") - 1).alias("_rn"), F.col("fi").alias("_fi2"), F.col("x").alias("x_next"))
    j = numbered.join(nxt, "_rn", "left")
    return j.withColumn("x_next", F.when(F.col("_fi2") == F.col("fi"), F.col("x_next"))).drop("_rn", "_fi2")


def _entropy(counts: list, n, log):
    h = F.lit(0.0)
    for c in counts:
        p = c / n
        h = h - F.when(c > 0, p * log(p)).otherwise(0.0)
    return h


def best_split(df: DataFrame, features: list[str], target: str, criterion: str = "bits",
               lam: float = 1.0, g: str = "g", h: str = "h") -> DataFrame:
    """M8: best (feature, threshold) over all features in one pass.

    ``bits``: base-2 information gain, left = ``x <= v`` at observed values.
    ``nats``: natural-log gain, threshold at midpoints, left = ``x < mid``.
    ``mse``: variance reduction with child means, midpoints (``mse_parent``:
    the reference variant measuring both sides against the parent mean).
    ``xgb``: ``1/2 [G_L^2/(H_L+l) + G_R^2/(H_R+l) - G^2/(H+l)]`` from columns ``g``, ``h``.
    Ties go to the first feature, then the smallest threshold.
    """
    if criterion in ("bits", "nats"):
        classes = sorted(r[0] for r in df.select(target).distinct().collect())  # bounded by #classes
        stats = {f"k{i}": (F.col(target) == F.lit(c)).cast("double") for i, c in enumerate(classes)}
    elif criterion in ("mse", "mse_parent"):
        stats = {"n": F.lit(1.0), "sy": F.col(target), "sq": F.col(target) * F.col(target)}
    elif criterion == "xgb":
        stats = {"sg": F.col(g), "sh": F.col(h)}
    else:
        raise ValueError(criterion)
    vt = value_table(df, features, stats)
    names = list(stats)
    L = {k: F.col(f"c_{k}") for k in names}
    T = {k: F.col(f"t_{k}") for k in names}
    R = {k: T[k] - L[k] for k in names}
    thr = F.col("x")
    if criterion in ("bits", "nats"):
        log = F.log2 if criterion == "bits" else F.log
        nl = sum((L[k] for k in names), F.lit(0.0))
        nt = sum((T[k] for k in names), F.lit(0.0))
        nr = nt - nl
        gain = (_entropy([T[k] for k in names], nt, log)
                - (nl / nt * _entropy([L[k] for k in names], nl, log) + nr / nt * _entropy([R[k] for k in names], nr, log)))
        gain = F.when((nl == 0) | (nr == 0), F.lit(0.0)).otherwise(gain)
        if criterion == "nats":
            vt = with_next_value(vt).where(F.col("x_next").isNotNull())
            thr = (F.col("x") + F.col("x_next")) / 2.0
    elif criterion in ("mse", "mse_parent"):
        vt = with_next_value(vt).where(F.col("x_next").isNotNull())
        thr = (F.col("x") + F.col("x_next")) / 2.0

        def sse(n, s, q):
            return q - s * s / n

        if criterion == "mse":
            gain = sse(T["n"], T["sy"], T["sq"]) - sse(L["n"], L["sy"], L["sq"]) - sse(R["n"], R["sy"], R["sq"])
        else:
            ybar = T["sy"] / T["n"]

            def dev(n, s, q):
                return q - 2 * ybar * s + n * ybar * ybar

            gain = -(dev(L["n"], L["sy"], L["sq"]) * L["n"] / T["n"] + dev(R["n"], R["sy"], R["sq"]) * R["n"] / T["n"])
    else:
        gain = 0.5 * (L["sg"] * L["sg"] / (L["sh"] + lam) + R["sg"] * R["sg"] / (R["sh"] + lam)
                      - T["sg"] * T["sg"] / (T["sh"] + lam))
    fname = F.element_at(F.array(*[F.lit(f) for f in features]), F.col("fi") + 1)
    scored = vt.select(fname.alias("feature"), "fi", thr.alias("threshold"), gain.alias("gain"))
    return scored.orderBy(F.desc("gain"), "fi", "threshold").limit(1).drop("fi")


# ------------------------------------------------------------------ closed forms

def ridge_fit(df: DataFrame, xs: list[str], y: str, alpha: float = 1.0) -> dict:
    """M2: ridge with an unpenalised intercept from centred Gram aggregates and a d x d solve.

    Equals ``LinearRegression(regParam=alpha/n, elasticNetParam=0, standardization=False)``.
    """
    aggs = [F.count(F.lit(1)).alias("n"), F.avg(y).alias("my")] + [F.avg(x).alias(f"m_{x}") for x in xs]
    aggs += [F.covar_pop(a, b).alias(f"c_{a}|{b}") for a in xs for b in xs]
    aggs += [F.covar_pop(a, y).alias(f"cy_{a}") for a in xs]
    r = df.agg(*aggs).first()
    n = r["n"]
    sxx = np.array([[r[f"c_{a}|{b}"] * n for b in xs] for a in xs])
    sxy = np.array([r[f"cy_{a}"] * n for a in xs])
    w = np.linalg.solve(sxx + alpha * np.eye(len(xs)), sxy)
    b0 = r["my"] - sum(wi * r[f"m_{x}"] for wi, x in zip(w, xs))
    return {"coef": dict(zip(xs, map(float, w))), "intercept": float(b0)}


def mse_gradient(df: DataFrame, xs: list[str], y: str, theta: list[float]) -> list[float]:
    """M3: ``2/m X^T (X theta - y)`` in one aggregate."""
    pred = sum((F.lit(float(t)) * F.col(x) for t, x in zip(theta, xs)), F.lit(0.0))
    r = df.agg(*[F.avg(2 * (pred - F.col(y)) * F.col(x)).alias(x) for x in xs]).first()
    return [float(r[x]) for x in xs]


def logistic_gd(df: DataFrame, xs: list[str], y: str, lr: float = 0.001, iters: int = 1000) -> np.ndarray:
    """M3: full-batch gradient descent on the log loss (with intercept): one aggregate per
    iteration on the persisted input; the input is checkpointed once so lost executors
    never replay its lineage."""
    data = cut_lineage(df.select(*xs, y))
    theta = np.zeros(len(xs) + 1)
    for _ in range(iters):
        z = F.lit(float(theta[0])) + sum((F.lit(float(t)) * F.col(x) for t, x in zip(theta[1:], xs)), F.lit(0.0))
        err = 1 / (1 + F.exp(-z)) - F.col(y)
        r = data.agg(F.avg(err).alias("b"), *[F.avg(err * F.col(x)).alias(x) for x in xs]).first()
        grad = np.array([r["b"]] + [r[x] for x in xs])
        theta = theta - lr * grad
    return theta


def gaussian_nb_fit(df: DataFrame, xs: list[str], label: str) -> DataFrame:
    """M6: per class prior, mean and population variance of every feature (long form)."""
    n = df.count()
    per = df.groupBy(label).agg(F.count(F.lit(1)).alias("n_c"),
                                *[F.avg(x).alias(f"m|{x}") for x in xs], *[F.var_pop(x).alias(f"v|{x}") for x in xs])
    rows = per.select(label, (F.col("n_c") / F.lit(float(n))).alias("prior"), F.explode(F.array(*[
        F.struct(F.lit(x).alias("feature"), F.col(f"m|{x}").alias("mean"), F.col(f"v|{x}").alias("var"))
        for x in xs])).alias("s"))
    return rows.select(label, "prior", "s.feature", "s.mean", "s.var")


def gaussian_nb_predict(df: DataFrame, xs: list[str], label: str, params: DataFrame, key: str) -> DataFrame:
    """M6: argmax of ``log prior + sum log N(x; mean, var)`` (logs: no underflow); ties -> smallest label.

    The fitted parameters (classes x features numbers) are read once and become
    literals of one projection: no join, everything stays in generated code.
    """
    rows = params.collect()  # one row per (class, feature)
    classes = sorted({r[label] for r in rows})
    par = {(r[label], r["feature"]): r for r in rows}
    scores = []
    for c in classes:
        ll = F.lit(math.log(par[(c, xs[0])]["prior"]))
        for x in xs:
            m, v = par[(c, x)]["mean"], par[(c, x)]["var"]
            ll = ll - 0.5 * math.log(2 * math.pi * v) - (F.col(x) - m) * (F.col(x) - m) / (2 * v)
        scores.append(F.struct(ll.alias("ll"), F.lit(-classes.index(c)).alias("tie"), F.lit(c).alias("cls")))
    best = F.greatest(*scores) if len(scores) > 1 else scores[0]
    return df.select(key, best["cls"].alias("pred"))


def ordinal_encode(label, k: int):
    """Label in 0..k-1 -> k-1 cumulative bits ``[label > j for j < k-1]``."""
    c = F.col(label) if isinstance(label, str) else label
    return F.transform(F.sequence(F.lit(0), F.lit(k - 2)), lambda j: (c > j).cast("int"))


def ordinal_decode(probs):
    """prediction = number of cumulative probabilities above 0.5."""
    c = F.col(probs) if isinstance(probs, str) else probs
    return F.aggregate(c, F.lit(0), lambda acc, p: acc + (p > 0.5).cast("int"))


# ------------------------------------------------------------------ boosting with stumps

def adaboost(df: DataFrame, key: str, features: list[str], label: str, rounds: int = 5) -> list[dict]:
    """AdaBoost with decision stumps, labels in {-1, 1}.

    A stump predicts 1 when ``x >= threshold`` (polarity 1) and flips when its
    weighted error exceeds 1/2.  Each round is one weighted value table; the
    weights live in a checkpointed column.
    """
    n = df.count()
    d = cut_lineage(df.select(key, *features, label).withColumn("w", F.lit(1.0 / n)))
    learners = []
    for _ in range(rounds):
        vt = value_table(d, features, {"wp": F.when(F.col(label) == 1, F.col("w")).otherwise(0.0),
                                       "wn": F.when(F.col(label) != 1, F.col("w")).otherwise(0.0)})
        below_p = F.col("c_wp") - F.col("s_wp")  # strictly below the threshold
        below_n = F.col("c_wn") - F.col("s_wn")
        err = below_p + (F.col("t_wn") - below_n)
        cand = vt.select("fi", F.col("x").alias("threshold"), err.alias("e0"))
        cand = cand.withColumn("polarity", F.when(F.col("e0") > 0.5, -1).otherwise(1)).withColumn(
            "error", F.when(F.col("e0") > 0.5, 1 - F.col("e0")).otherwise(F.col("e0")))
        best = cand.orderBy("error", "fi", "threshold").first()
        eps = 1e-10
        alpha = 0.5 * math.log((1.0 - best["error"] + eps) / (best["error"] + eps))
        f = features[best["fi"]]
        p = best["polarity"]
        pred = F.when(F.lit(p) * F.col(f) < F.lit(p * best["threshold"]), -1.0).otherwise(1.0)
        d = d.withColumn("w", F.col("w") * F.exp(-alpha * F.col(label) * pred))
        total = d.agg(F.sum("w")).first()[0]
        d = cut_lineage(d.withColumn("w", F.col("w") / total))
        learners.append({"feature": f, "threshold": best["threshold"], "polarity": p, "alpha": alpha,
                         "error": best["error"]})
    return learners


def adaboost_predict(df: DataFrame, learners: list[dict]):
    """``sign(sum alpha * stump)``."""
    s = F.lit(0.0)
    for m in learners:
        p = m["polarity"]
        s = s + m["alpha"] * F.when(F.lit(p) * F.col(m["feature"]) < F.lit(p * m["threshold"]), -1.0).otherwise(1.0)
    return F.signum(s)


def boost_stumps(df: DataFrame, key: str, features: list[str], target: str, rounds: int = 5, lr: float = 0.1,
                 weighted: bool = False) -> dict:
    """Gradient boosting of regression stumps from the mean.

    A stump splits ``x <= threshold`` and predicts side means; its loss is
    ``mse_left + mse_right`` (the reference), or the usual SSE with ``weighted``.
    """
    init = df.agg(F.avg(target)).first()[0]
    d = cut_lineage(df.select(key, *features, target).withColumn("pred", F.lit(float(init))))
    stumps = []
    for _ in range(rounds):
        r = F.col(target) - F.col("pred")
        vt = value_table(d, features, {"n": F.lit(1.0), "s": r, "q": r * r})
        nl, sl, ql = F.col("c_n"), F.col("c_s"), F.col("c_q")
        nr, sr, qr = F.col("t_n") - nl, F.col("t_s") - sl, F.col("t_q") - ql
        if weighted:
            loss = (ql - sl * sl / nl) + (qr - sr * sr / nr)
        else:
            loss = (ql / nl - (sl / nl) * (sl / nl)) + (qr / nr - (sr / nr) * (sr / nr))
        cand = vt.where(nr > 0).select("fi", F.col("x").alias("threshold"), loss.alias("loss"),
                                       (sl / nl).alias("left"), (sr / nr).alias("right"))
        best = cand.orderBy("loss", "fi", "threshold").first()
        if best is None:
            break
        f = features[best["fi"]]
        step = F.when(F.col(f) <= best["threshold"], best["left"]).otherwise(best["right"])
        d = cut_lineage(d.withColumn("pred", F.col("pred") + lr * step))
        stumps.append({"feature": f, "threshold": best["threshold"], "left": best["left"], "right": best["right"]})
    return {"init": init, "lr": lr, "stumps": stumps}


def boost_predict(model: dict):
    """Prediction column of :func:`boost_stumps`."""
    s = F.lit(float(model["init"]))
    for st in model["stumps"]:
        s = s + model["lr"] * F.when(F.col(st["feature"]) <= st["threshold"], st["left"]).otherwise(st["right"])
    return s


# ------------------------------------------------------------------ ID3 (level-wise)

def id3(df: DataFrame, attrs: list[str], target: str, max_depth: int = 3) -> DataFrame:
    """ID3 on categorical attributes, grown level by level.

    Every node of a level is handled by the same aggregate, keyed by the node
    path: ``(node, attr, value, target)`` counts give each node's best
    attribute (largest base-2 gain, ties by attribute order).  Returns the
    leaves ``(node, prediction, n)`` with the majority label (ties: smallest).
    """
    d = cut_lineage(df.select(*[F.col(a).cast("string").alias(a) for a in attrs], target)
                    .withColumn("node", F.lit("")).withColumn("used", F.array().cast("array<string>")))
    for _ in range(max_depth):
        long = d.select("node", "used", target, F.inline(F.array(*[
            F.struct(F.lit(i).alias("ai"), F.lit(a).alias("attr"), F.col(a).alias("value")) for i, a in enumerate(attrs)])))
        long = long.where(~F.array_contains("used", F.col("attr")))
        c = long.groupBy("node", "ai", "attr", "value", target).agg(F.count(F.lit(1)).alias("n"))
        pv = c.groupBy("node", "ai", "attr", "value").agg(F.sum("n").alias("nv"), F.collect_list("n").alias("_ns"))
        hv = pv.select("node", "ai", "attr", "nv", F.aggregate(
            "_ns", F.lit(0.0), lambda a, x: a - (x / F.col("nv")) * F.log2(x / F.col("nv"))).alias("hv"))
        cond = hv.groupBy("node", "ai", "attr").agg(F.sum(F.col("nv") * F.col("hv")).alias("_w"),
                                                    F.sum("nv").alias("_n"))
        # parent entropy is the same for every attribute of a node: max gain = min conditional entropy
        w = Window.partitionBy("node").orderBy(F.col("_w") / F.col("_n"), "ai")
        best = cond.withColumn("_r", F.row_number().over(w)).where(F.col("_r") == 1).select("node", "attr")
        pure = d.groupBy("node").agg(F.countDistinct(target).alias("_k")).where(F.col("_k") > 1).select("node")
        best = best.join(pure, "node", "left_semi")
        if best.limit(1).count() == 0:
            break
        d2 = d.join(best, "node", "left")
        split_val = F.coalesce(*[F.when(F.col("attr") == a, F.col(a)) for a in attrs])
        d = cut_lineage(d2.withColumn("node", F.when(F.col("attr").isNotNull(), F.concat(
            F.col("node"), F.lit("/"), F.col("attr"), F.lit("="), F.coalesce(split_val, F.lit("null")))).otherwise(F.col("node")))
            .withColumn("used", F.when(F.col("attr").isNotNull(), F.array_append("used", F.col("attr"))).otherwise(F.col("used")))
            .drop("attr"))
    counts = d.groupBy("node", target).agg(F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy("node").orderBy(F.desc("n"), target)
    return counts.withColumn("_r", F.row_number().over(w)).where(F.col("_r") == 1).select(
        "node", F.col(target).alias("prediction"), "n")


# ------------------------------------------------------------------ MLlib-backed

def fraud_pipeline(features: list[str], label: str = "Class", num_trees: int = 20, max_depth: int = 5, seed: int = 1):
    """M1: VectorAssembler -> RandomForestClassifier (the reference's Spark defaults)."""
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import RandomForestClassifier
    from pyspark.ml.feature import VectorAssembler

    return Pipeline(stages=[VectorAssembler(inputCols=features, outputCol="features"),
                            RandomForestClassifier(labelCol=label, featuresCol="features", numTrees=num_trees,
                                                   maxDepth=max_depth, impurity="gini", maxBins=32, seed=seed)])


def linear_svm(df: DataFrame, features: str, label: str, reg: float = 0.01):
    """M5: hinge loss + L2 (batch OWL-QN instead of per-sample SGD: same objective)."""
    from pyspark.ml.classification import LinearSVC

    return LinearSVC(featuresCol=features, labelCol=label, regParam=reg, maxIter=100).fit(df)


def tree_models(kind: str, label: str, features: str = "features", classification: bool = True, seed: int = 1,
                **params):
    """M9: decision tree / random forest / gradient-boosted trees of MLlib."""
    from pyspark.ml import classification as C
    from pyspark.ml import regression as R

    cls = {("tree", True): C.DecisionTreeClassifier, ("forest", True): C.RandomForestClassifier,
           ("gbt", True): C.GBTClassifier, ("tree", False): R.DecisionTreeRegressor,
           ("forest", False): R.RandomForestRegressor, ("gbt", False): R.GBTRegressor}[(kind, classification)]
    if kind != "tree":
        params.setdefault("seed", seed)
    return cls(labelCol=label, featuresCol=features, **params)


def compare_regressors(train: DataFrame, test: DataFrame, features: str, label: str, exp_back: bool = True,
                       seed: int = 1) -> DataFrame:
    """Fit linear, ridge, tree, forest and GBT regressors on train; MAE/RMSE/R2 on test,
    after ``exp`` back-transformation of log targets (SVR and MLP have no Spark counterpart)."""
    from pyspark.ml.regression import (DecisionTreeRegressor, GBTRegressor, LinearRegression,
                                       RandomForestRegressor)

    models = {
        "linear": LinearRegression(featuresCol=features, labelCol=label),
        "ridge": LinearRegression(featuresCol=features, labelCol=label, regParam=1.0, elasticNetParam=0.0),
        "tree": DecisionTreeRegressor(featuresCol=features, labelCol=label, seed=seed),
        "forest": RandomForestRegressor(featuresCol=features, labelCol=label, seed=seed),
        "gbt": GBTRegressor(featuresCol=features, labelCol=label, seed=seed),
    }
    rows = []
    for name, est in models.items():
        pred = est.fit(train).transform(test)
        a, p = F.col(label), F.col("prediction")
        if exp_back:
            a, p = F.exp(a), F.exp(p)
        r = pred.agg(F.avg(F.abs(a - p)).alias("mae"), F.sqrt(F.avg((a - p) * (a - p))).alias("rmse"),
                     (1 - F.sum((a - p) * (a - p)) / (F.var_pop(a) * F.count(F.lit(1)))).alias("r2")).first()
        rows.append((name, float(r["mae"]), float(r["rmse"]), float(r["r2"])))
    return train.sparkSession.createDataFrame(rows, "model string, mae double, rmse double, r2 double")


def gbt_fraud(train: DataFrame, features: str, label: str, valid_col: str | None = None, seed: int = 1):
    """Boosted trees, row subsample 0.8, depth 5, 100 rounds, early stop on a validation flag."""
    from pyspark.ml.classification import GBTClassifier

    kw = dict(labelCol=label, featuresCol=features, maxDepth=5, maxIter=100, subsamplingRate=0.8, seed=seed)
    if valid_col:
        kw["validationIndicatorCol"] = valid_col
    return GBTClassifier(**kw).fit(train)


def score_batches(df: DataFrame, model, batch_rows: int = 500) -> DataFrame:
    """Batched scoring.  A Spark model scores in the JVM; any other ``model`` is a function from a
    pandas frame to one score per row and is called on at most ``batch_rows`` rows at a time."""
    if hasattr(model, "transform"):
        return model.transform(df)

    def run(frames):
        for frame in frames:
            for k in range(0, len(frame), batch_rows):
                part = frame.iloc[k : k + batch_rows]
                yield part.assign(prediction=[float(x) for x in model(part)])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)
    return df.mapInPandas(run, f"{fields}, prediction double")


def search(estimator, grid: dict, evaluator, train: DataFrame, random: int | None = None, seed: int = 0,
           parallelism: int = 2):
    """Q11: grid search (all combinations) or random search (``random`` seeded draws) with a
    train/validation split.  A dimension is a list of values, or for random search a
    ``(low, high)`` tuple drawn uniformly."""
    import random as _random

    from pyspark.ml.tuning import ParamGridBuilder, TrainValidationSplit

    ranges = {p: v for p, v in grid.items() if isinstance(v, tuple)}
    if ranges and random is None:
        raise ValueError("a range needs random search")
    b = ParamGridBuilder()
    for p, vals in grid.items():
        if p not in ranges:
            b = b.addGrid(p, vals)
    maps = b.build()
    if random is not None:
        rng = _random.Random(seed)
        if ranges:
            maps = [rng.choice(maps) | {p: rng.uniform(*v) for p, v in ranges.items()} for _ in range(random)]
        else:
            maps = rng.sample(maps, min(random, len(maps)))
    tvs = TrainValidationSplit(estimator=estimator, estimatorParamMaps=maps, evaluator=evaluator, trainRatio=0.8,
                               parallelism=parallelism, seed=seed)
    return tvs.fit(train)
