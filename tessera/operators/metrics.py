"""Evaluation metrics (V1-V11) as single-pass aggregates.

Curves (ROC/PR) need running sums over the distinct scores in score order;
those use :func:`tessera.operators.ranking.global_cumsum` (range partitioned),
never a single-task window.
"""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from tessera.operators.quantiles import exact_percentiles
from tessera.operators.ranking import global_cumsum

EPSILON = 1e-10


# ------------------------------------------------------------- V1

def binary_metrics(df: DataFrame, y_true: str = "y_true", y_pred: str = "y_pred") -> DataFrame:
    """V1: confusion counts, accuracy, precision, recall, F1 (0 when undefined)."""
    y, p = F.col(y_true), F.col(y_pred)
    c = df.agg(F.count_if((p == 1) & (y == 1)).alias("tp"), F.count_if((p == 1) & (y == 0)).alias("fp"),
               F.count_if((p == 0) & (y == 1)).alias("fn"), F.count_if((p == 0) & (y == 0)).alias("tn"),
               F.count(F.lit(1)).alias("n"))
    tp, fp, fn, tn = (F.col(x) for x in ("tp", "fp", "fn", "tn"))
    prec = F.when(tp + fp > 0, tp / (tp + fp)).otherwise(0.0)
    rec = F.when(tp + fn > 0, tp / (tp + fn)).otherwise(0.0)
    c = c.withColumn("accuracy", (tp + tn) / F.col("n")).withColumn("precision", prec).withColumn("recall", rec)
    return c.withColumn("f1", F.when(F.col("precision") + F.col("recall") > 0,
                                     2 * F.col("precision") * F.col("recall") / (F.col("precision") + F.col("recall")))
                        .otherwise(0.0)).drop("n")


# ------------------------------------------------------------- V2

def _score_table(df: DataFrame, y_true: str, score: str) -> DataFrame:
    """Positives and negatives per distinct score, highest score first, with running totals."""
    per = df.groupBy(F.col(score).alias("threshold")).agg(
        F.sum(F.col(y_true).cast("double")).alias("pos"),
        F.sum((1 - F.col(y_true)).cast("double")).alias("neg"))
    return global_cumsum(per, [F.desc("threshold")], ["pos", "neg"])


def roc_curve(df: DataFrame, y_true: str = "y_true", score: str = "score") -> DataFrame:
    """V2: one point per distinct score (ties grouped): threshold, fpr, tpr."""
    tot = df.agg(F.sum(F.col(y_true)).alias("P"), F.count(F.lit(1)).alias("N")).first()
    P, N = float(tot["P"]), float(tot["N"] - tot["P"])
    t = _score_table(df, y_true, score)
    return t.select("threshold", (F.col("neg_cum") / N).alias("fpr"), (F.col("pos_cum") / P).alias("tpr"))


def pr_curve(df: DataFrame, y_true: str = "y_true", score: str = "score") -> DataFrame:
    """V2: precision and recall at every distinct score."""
    P = float(df.agg(F.sum(F.col(y_true))).first()[0])
    t = _score_table(df, y_true, score)
    return t.select("threshold", (F.col("pos_cum") / (F.col("pos_cum") + F.col("neg_cum"))).alias("precision"),
                    (F.col("pos_cum") / P).alias("recall"))


def auc_summary(df: DataFrame, y_true: str = "y_true", score: str = "score") -> DataFrame:
    """V2: ROC AUC (trapezoids over the grouped curve = rank-sum with ties at 1/2),
    PR AUC (trapezoids over recall with the (0, 1) start point) and average precision.
    Null where a class is missing."""
    tot = df.agg(F.coalesce(F.sum(F.col(y_true)), F.lit(0)).alias("P"), F.count(F.lit(1)).alias("N")).first()
    P, N = float(tot["P"]), float(tot["N"] - tot["P"])
    t = _score_table(df, y_true, score)
    tp, fp = F.col("pos_cum"), F.col("neg_cum")
    tp0, fp0 = tp - F.col("pos"), fp - F.col("neg")  # running totals before this score
    prec = tp / (tp + fp)
    prec0 = F.when(tp0 + fp0 > 0, tp0 / (tp0 + fp0)).otherwise(1.0)
    return t.agg(
        F.try_divide(F.sum((fp - fp0) * (tp + tp0) / 2.0), F.lit(P * N)).alias("roc_auc"),
        (F.sum(F.try_divide(tp - tp0, F.lit(P)) * (prec + prec0) / 2.0)).alias("pr_auc"),
        (F.sum(F.try_divide(tp - tp0, F.lit(P)) * prec)).alias("average_precision"),
    )


def auc_rank(df: DataFrame, y_true: str = "y_true", score: str = "score") -> DataFrame:
    """V2: ROC AUC from ranks: sum over positives of (#negatives below + #negatives tied / 2)."""
    tot = df.agg(F.coalesce(F.sum(F.col(y_true)), F.lit(0)).alias("P"), F.count(F.lit(1)).alias("N")).first()
    P, N = float(tot["P"]), float(tot["N"] - tot["P"])
    per = df.groupBy(F.col(score).alias("threshold")).agg(
        F.sum(F.col(y_true).cast("double")).alias("pos"), F.sum((1 - F.col(y_true)).cast("double")).alias("neg"))
    t = global_cumsum(per, ["threshold"], ["neg"])
    return t.agg(F.try_divide(F.sum(F.col("pos") * (F.col("neg_cum") - F.col("neg") / 2.0)), F.lit(P * N)).alias("roc_auc"))


# ------------------------------------------------------------- V3

def best_threshold(df: DataFrame, y_true: str = "y_true", score: str = "score", grid: int = 1000,
                   cost_fn: float = 500.0, cost_fp: float = 100.0, cost_tp: float = 100.0,
                   cost_tn: float = 0.0) -> DataFrame:
    """V3: first threshold of ``linspace(0, 1, grid)`` with the minimum cost, predicting
    positive when ``score >= threshold``.

    One pass buckets every score by the number of grid points below or at it;
    running sums over the (at most ``grid``) buckets give the confusion counts of
    every threshold at once - O(n + grid) instead of O(n * grid).
    """
    step = 1.0 / (grid - 1)
    s = F.col(score)
    b0 = F.floor(s / step).cast("int")
    b = (F.when((b0 + 1) * step <= s, b0 + 1).when(b0 * step > s, b0 - 1).otherwise(b0))
    b = F.least(F.greatest(b, F.lit(-1)), F.lit(grid - 1))
    per = df.groupBy(b.alias("bucket")).agg(
        F.sum(F.col(y_true).cast("double")).alias("pos"), F.sum((1 - F.col(y_true)).cast("double")).alias("neg"))
    spark = df.sparkSession
    grid_df = spark.range(-1, grid).select(F.col("id").cast("int").alias("bucket"))
    full = grid_df.join(per, "bucket", "left").fillna(0.0, ["pos", "neg"])
    t = global_cumsum(full, [F.desc("bucket")], ["pos", "neg"], num_partitions=1)  # <= grid + 1 rows
    tot = df.agg(F.sum(F.col(y_true)).alias("P"), F.count(F.lit(1)).alias("N")).first()
    P, N = float(tot["P"]), float(tot["N"] - tot["P"])
    tp, fp = F.col("pos_cum"), F.col("neg_cum")
    cost = cost_fn * (P - tp) + cost_tn * (N - fp) + cost_fp * fp + cost_tp * tp
    scored = t.where(F.col("bucket") >= 0).select((F.col("bucket") * step).alias("threshold"), cost.alias("cost"))
    return scored.orderBy("cost", "threshold").limit(1)


# ------------------------------------------------------------- V4, V5

def regression_metrics(df: DataFrame, actual: str = "actual", predicted: str = "predicted") -> DataFrame:
    """V4: MAE, MSE, RMSE, R2, MSLE, RMSLE."""
    a, p = F.col(actual), F.col(predicted)
    e = a - p
    le = F.log1p(a) - F.log1p(p)
    r = df.agg(F.avg(F.abs(e)).alias("mae"), F.avg(e * e).alias("mse"), F.avg(le * le).alias("msle"),
               F.sum(e * e).alias("_sse"), (F.var_pop(a) * F.count(F.lit(1))).alias("_sst"))
    return r.select("mae", "mse", F.sqrt("mse").alias("rmse"), (1 - F.col("_sse") / F.col("_sst")).alias("r2"),
                    "msle", F.sqrt("msle").alias("rmsle"))


def loss_metrics(df: DataFrame, actual: str = "actual", predicted: str = "predicted") -> DataFrame:
    """V5: classification error, log loss (clip 1e-15), hinge (labels in {-1, 1} or {0, 1}),
    binary cross-entropy as mean (and the reference's sum form)."""
    a, p = F.col(actual).cast("double"), F.col(predicted).cast("double")
    pc = F.least(F.greatest(p, F.lit(1e-15)), F.lit(1 - 1e-15))
    ll = -(a * F.log(pc) + (1 - a) * F.log(1 - pc))
    ypm = F.when(a == 0, -1.0).otherwise(a)
    return df.agg(
        F.avg((a != p).cast("double")).alias("classification_error"),
        F.avg(ll).alias("log_loss"),
        F.avg(F.greatest(F.lit(0.0), 1 - ypm * p)).alias("hinge"),
        F.sum(ll).alias("bce_sum"),
    )


# ------------------------------------------------------------- V6

FORECAST_METRICS = (
    "mse rmse nrmse me mae mad gmae mdae mpe mape mdape smape smdape maape mase std_ae std_ape rmspe "
    "rmdspe rmsse inrse rrse mre rae mrae mdrae gmrae mbrae umbrae mda bias r2").split()


def _gmean_abs(x: Column) -> Column:
    """exp(mean(log|x|)); any zero gives 0 (log(0) = -inf)."""
    return F.when(F.min(F.abs(x)) == 0, F.lit(0.0)).otherwise(F.exp(F.avg(F.log(F.abs(x)))))


def forecast_metrics(df: DataFrame, key, ts: str, actual: str = "actual", predicted: str = "predicted",
                     names: list[str] | None = None, seasonality: int = 1) -> DataFrame:
    """V6: the 32 forecast metrics per series, long form ``(key..., metric, value)``.

    Percentage errors are not multiplied by 100; ``EPSILON = 1e-10`` guards
    divisions; the naive benchmark is the actual ``seasonality`` steps back.
    std_ae / std_ape keep the reference's definition (spread of the signed
    error around MAE / MAPE).  A metric whose divisor is 0 (a constant or
    one-row series) is null.
    """
    keys = [key] if isinstance(key, str) else list(key)
    names = names or FORECAST_METRICS
    w = Window.partitionBy(*keys).orderBy(ts)
    a, p = F.col(actual), F.col(predicted)
    base = df.select(*keys, ts, a.alias("a"), p.alias("p")).where(F.col("a").isNotNull() & F.col("p").isNotNull())
    mean_a = base.groupBy(*keys).agg(F.avg("a").alias("_mean"))
    base = base.join(mean_a, keys)
    base = base.select(
        "*", (F.col("a") - F.col("p")).alias("e"),
        ((F.col("a") - F.col("p")) / (F.col("a") + EPSILON)).alias("pe"),
        (F.col("a") - F.lag("a", seasonality).over(w)).alias("nd"),
        (F.signum(F.col("a") - F.lag("a").over(w)) == F.signum(F.col("p") - F.lag("p").over(w))).alias("dir"))
    e, pe, nd = F.col("e"), F.col("pe"), F.col("nd")
    re = F.when(nd.isNotNull(), e / (nd + EPSILON))
    bre = F.when(nd.isNotNull(), F.abs(e) / (F.abs(e) + F.abs(nd) + EPSILON))
    sape = 2.0 * F.abs(e) / (F.abs(F.col("a")) + F.abs(F.col("p")) + EPSILON)
    n = F.count(F.lit(1))
    mae = F.avg(F.abs(e))
    mape = F.avg(F.abs(pe))
    sst = F.var_pop("a") * n
    mae_naive = F.avg(F.abs(nd))
    exprs = {
        "mse": F.avg(e * e), "rmse": F.sqrt(F.avg(e * e)),
        "nrmse": F.try_divide(F.sqrt(F.avg(e * e)), F.max("a") - F.min("a")),
        "me": F.avg(e), "mae": mae, "mad": mae, "gmae": _gmean_abs(e),
        "mpe": F.avg(pe), "mape": mape,
        "smape": F.avg(sape),
        "maape": F.avg(F.atan(F.abs((F.col("a") - F.col("p")) / (F.col("a") + EPSILON)))),
        "mase": F.try_divide(mae, mae_naive),
        "std_ae": F.sqrt(F.try_divide(F.sum(e * e) - 2 * mae * F.sum(e) + n * mae * mae, n - 1)),
        "std_ape": F.sqrt(F.try_divide(F.sum(pe * pe) - 2 * mape * F.sum(pe) + n * mape * mape, n - 1)),
        "rmspe": F.sqrt(F.avg(pe * pe)),
        "rmsse": F.try_divide(F.sqrt(F.avg(e * e)), mae_naive),
        "inrse": F.sqrt(F.try_divide(F.sum(e * e), sst)), "rrse": F.sqrt(F.try_divide(F.sum(e * e), sst)),
        "mre": F.avg(re), "rae": F.sum(F.abs(e)) / (F.sum(F.abs(F.col("a") - F.col("_mean"))) + EPSILON),
        "mrae": F.avg(F.abs(re)), "gmrae": _gmean_abs(re),
        "mbrae": F.avg(bre), "umbrae": F.try_divide(F.avg(bre), 1 - F.avg(bre)),
        "mda": F.avg(F.col("dir").cast("double")), "bias": F.avg(e),
        "r2": 1 - F.try_divide(F.sum(e * e), sst),
    }
    wide = base.groupBy(*keys).agg(*[exprs[m].cast("double").alias(m) for m in names if m in exprs])
    plain = wide.unpivot(keys, [m for m in names if m in exprs], "metric", "value")
    middles = {"mdae": F.abs(e), "mdape": F.abs(pe), "smdape": sape, "rmdspe": pe * pe, "mdrae": F.abs(re)}
    wanted = [m for m in names if m in middles]
    if not wanted:
        return plain
    # all medians in one pass: a value per (series, metric), ranked across the cluster
    long = base.select(*keys, F.explode(F.array(*[
        F.struct(F.lit(m).alias("metric"), middles[m].cast("double").alias("x")) for m in wanted])).alias("_m")).select(*keys, "_m.*")
    found = exact_percentiles(long, [*keys, "metric"], "x", {"value": 0.5})
    found = found.withColumn("value", F.when(F.col("metric") == "rmdspe", F.sqrt("value")).otherwise(F.col("value")))
    empty = wide.select(*keys, F.explode(F.array(*[F.lit(m) for m in wanted])).alias("metric"))
    marked = found.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], F.col("metric").alias("_metric"), "value")
    on = F.col("metric") == F.col("_metric")
    for i, k in enumerate(keys):
        on = on & F.col(k).eqNullSafe(F.col(f"_k{i}"))
    return plain.unionByName(empty.join(marked, on, "left").select(*keys, "metric", "value"))


# ------------------------------------------------------------- V7

def iou(df: DataFrame, true: str, pred: str, num_classes: int) -> DataFrame:
    """V7: per-class IoU from the confusion counts (classes >= num_classes ignored), plus
    mean IoU over classes 1.. and pixel accuracy (both with the 1e-8 guard)."""
    cm = df.where((F.col(true) < num_classes) & (F.col(pred) < num_classes)).groupBy(
        F.col(true).alias("t"), F.col(pred).alias("p")).agg(F.count(F.lit(1)).alias("n"))
    spark = df.sparkSession
    classes = spark.range(num_classes).select(F.col("id").cast("int").alias("cls"))
    inter = cm.where(F.col("t") == F.col("p")).select(F.col("t").alias("cls"), F.col("n").alias("inter"))
    rows = cm.groupBy(F.col("t").alias("cls")).agg(F.sum("n").alias("row"))
    cols = cm.groupBy(F.col("p").alias("cls")).agg(F.sum("n").alias("col"))
    per = (classes.join(inter, "cls", "left").join(rows, "cls", "left").join(cols, "cls", "left")
           .fillna(0, ["inter", "row", "col"]))
    per = per.withColumn("iou", F.col("inter") / (F.col("row") + F.col("col") - F.col("inter") + 1e-8))
    summary = per.agg(F.avg(F.when(F.col("cls") >= 1, F.col("iou"))).alias("mean_iou"),
                      (F.sum("inter") / (F.sum("row") + 1e-8)).alias("pixel_accuracy"))
    return per.select("cls", "iou"), summary


# ------------------------------------------------------------- V8

def divergence(p: DataFrame, q: DataFrame, key: str = "k", prob: str = "prob") -> DataFrame:
    """V8: KL(p||q), Jensen-Shannon and Hellinger over the union of supports (missing = 0)."""
    j = p.select(key, F.col(prob).alias("p")).join(q.select(key, F.col(prob).alias("q")), key, "full").fillna(
        0.0, ["p", "q"])
    m = (F.col("p") + F.col("q")) / 2

    def kl_term(x, y):
        return F.when(x > 0, x * F.log(x / y)).otherwise(0.0)

    return j.agg(
        F.sum(kl_term(F.col("p"), F.col("q"))).alias("kl"),
        (0.5 * F.sum(kl_term(F.col("p"), m)) + 0.5 * F.sum(kl_term(F.col("q"), m))).alias("js"),
        F.sqrt(0.5 * F.sum(F.pow(F.sqrt("p") - F.sqrt("q"), 2))).alias("hellinger"),
    )


def distribution(df: DataFrame, group: str, key: str = "k", prob: str = "prob") -> DataFrame:
    """Empirical distribution of ``group`` values (helper for V8)."""
    c = df.groupBy(F.col(group).alias(key)).agg(F.count(F.lit(1)).alias("_n"))
    total = df.count()
    return c.select(key, (F.col("_n") / F.lit(float(total))).alias(prob))


# ------------------------------------------------------------- V9, V10

def rate_estimates(df: DataFrame, group, outcome: str, prior_heads: float, prior_tails: float) -> DataFrame:
    """V9: MLE (mean) and MAP ``(heads + a) / (n + a + b)`` of a 0/1 rate per group."""
    keys = [group] if isinstance(group, str) else list(group)
    return df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"), F.sum(outcome).alias("heads"), F.avg(outcome).alias("mle"),
        ((F.sum(outcome) + prior_heads) / (F.count(F.lit(1)) + prior_heads + prior_tails)).alias("map"))


@F.pandas_udf(DoubleType())
def lgamma(x: pd.Series) -> pd.Series:
    """log-gamma on an Arrow batch (Spark SQL has no built-in lgamma)."""
    return x.map(math.lgamma)


def _log_beta_pdf_half(a: Column, b: Column) -> Column:
    """log Beta-pdf at 0.5 = (a+b-2) log 0.5 - log B(a, b)."""
    return (a + b - 2) * F.lit(math.log(0.5)) - (lgamma(a) + lgamma(b) - lgamma(a + b))


def bayes_factor(df: DataFrame, group, outcome: str, alpha: float = 1.0, beta: float = 1.0) -> DataFrame:
    """Fair-coin evidence 0.5^N and the Beta-prior model's Savage-Dickey ratio
    ``Beta.pdf(0.5; h+a, t+b) / Beta.pdf(0.5; a, b)`` per group (computed in log space)."""
    keys = [group] if isinstance(group, str) else list(group)
    c = df.groupBy(*keys).agg(F.count(F.lit(1)).cast("double").alias("n"), F.sum(outcome).cast("double").alias("heads"))
    a0, b0 = F.lit(float(alpha)), F.lit(float(beta))
    log_m1 = _log_beta_pdf_half(F.col("heads") + a0, F.col("n") - F.col("heads") + b0) - _log_beta_pdf_half(a0, b0)
    return c.select(*keys, "n", "heads", (F.col("n") * math.log(0.5)).alias("log_evidence_fair"),
                    log_m1.alias("log_savage_dickey"))


# ------------------------------------------------------------- V11

def permutation_importance(model, df: DataFrame, features: list[str], evaluator, key: str, seed: int = 0,
                           assemble=None) -> DataFrame:
    """Metric drop when one feature column is permuted.

    The permutation pairs each row with the row at the same rank under a keyed
    hash order (a 1:1 join on a dense rank, no driver shuffle), so it is
    reproducible and survives retries.  ``assemble`` rebuilds the feature
    vector from the columns when the model expects one.
    """
    from tessera.operators.ranking import global_row_number

    prep = assemble or (lambda d: d)
    base = evaluator.evaluate(model.transform(prep(df)))
    ranked = global_row_number(df, [key], "_r1")
    out = []
    for f in features:
        donor = global_row_number(
            df.select(F.col(key).alias("_k2"), F.col(f).alias("_v"),
                      F.xxhash64(F.lit(seed), F.lit(f), F.col(key)).alias("_h")), ["_h", "_k2"], "_r1")
        perm = ranked.join(donor.select("_r1", "_v"), "_r1").drop(f, "_r1").withColumnRenamed("_v", f)
        score = evaluator.evaluate(model.transform(prep(perm)))
        out.append((f, float(base), float(score), float(base - score)))
    return df.sparkSession.createDataFrame(out, "feature string, base double, permuted double, importance double")


def partial_dependence(model, df: DataFrame, feature: str, grid: list[float], assemble=None) -> DataFrame:
    """Mean prediction with ``feature`` set to each grid value in every row (``value, prediction``).

    One aggregate over the rows times the grid; the grid is a parameter.
    """
    prep = assemble or (lambda d: d)
    rows = df.drop(feature).withColumn(feature, F.explode(F.array(*[F.lit(float(g)) for g in grid])))
    scored = model.transform(prep(rows))
    return scored.groupBy(F.col(feature).alias("value")).agg(F.avg("prediction").alias("prediction"))


# ------------------------------------------------------------- F6

def density_scores(df: DataFrame, group, col: str, family: str = "normal", trials: int | None = None,
                   out: str = "log_density") -> DataFrame:
    """fit a distribution per group, then score every row by its log density/mass.

    ``normal`` (mean, population variance), ``halfnormal`` (sigma^2 = mean x^2),
    ``bernoulli`` (p = mean), ``binomial`` with ``trials`` (p = mean / trials),
    ``poisson`` (lambda = mean).  Fitting is one partial aggregate; the per-group
    parameters (one row per group) are joined back.  Log-factorials use log-gamma.
    """
    keys = [group] if isinstance(group, str) else list(group)
    x = F.col(col).cast("double")
    fit = df.groupBy(*keys).agg(F.avg(x).alias("_m"), F.var_pop(x).alias("_v"), F.avg(x * x).alias("_q"))
    d = df.join(fit, keys)
    m, v, q = F.col("_m"), F.col("_v"), F.col("_q")
    if family == "normal":
        ld = -0.5 * F.log(2 * math.pi * v) - (x - m) * (x - m) / (2 * v)
    elif family == "halfnormal":
        ld = F.when(x >= 0, 0.5 * F.log(2 / (math.pi * q)) - x * x / (2 * q))
    elif family == "bernoulli":
        ld = x * F.log(m) + (1 - x) * F.log(1 - m)
    elif family == "binomial":
        p = m / trials
        ld = (lgamma(F.lit(float(trials + 1))) - lgamma(x + 1) - lgamma(F.lit(float(trials)) - x + 1)
              + x * F.log(p) + (F.lit(float(trials)) - x) * F.log(1 - p))
    elif family == "poisson":
        ld = x * F.log(m) - m - lgamma(x + 1)
    else:
        raise ValueError(family)
    return d.withColumn(out, ld).drop("_m", "_v", "_q")
