"""Evaluation-metric queries."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from tessera.operators import metrics as M
from tessera.plans.common import DAILY_SQL, SCORED_SQL, daily, scored
from tessera.plans.registry import query
from tessera.session import Tables


@query("v1_binary_metrics", f"""
WITH {SCORED_SQL}, p AS (SELECT y_true, CAST(score >= 0.1 AS INTEGER) AS y_pred FROM scored),
c AS (SELECT count(*) FILTER (WHERE y_pred = 1 AND y_true = 1) AS tp, count(*) FILTER (WHERE y_pred = 1 AND y_true = 0) AS fp,
             count(*) FILTER (WHERE y_pred = 0 AND y_true = 1) AS fn, count(*) FILTER (WHERE y_pred = 0 AND y_true = 0) AS tn,
             count(*) AS n FROM p),
m AS (SELECT *, (tp + tn) / n AS accuracy, CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0.0 END AS precision,
             CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0.0 END AS recall FROM c)
SELECT tp, fp, fn, tn, round(accuracy, 9) AS accuracy, round(precision, 9) AS precision, round(recall, 9) AS recall,
       round(CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall) ELSE 0.0 END, 9) AS f1
FROM m
""")
def v1_binary_metrics(spark, sf_dir):
    s = scored(Tables(spark, sf_dir)).withColumn("y_pred", (F.col("score") >= 0.1).cast("int"))
    r = M.binary_metrics(s, "y_true", "y_pred")
    return r.select("tp", "fp", "fn", "tn", *[F.round(c, 9).alias(c) for c in ("accuracy", "precision", "recall", "f1")])


_CURVE_SQL = f"""
WITH {SCORED_SQL},
per AS (SELECT score AS threshold, sum(y_true) AS pos, sum(1 - y_true) AS neg FROM scored GROUP BY score),
cum AS (SELECT threshold, pos, neg, sum(pos) OVER (ORDER BY threshold DESC) AS tp, sum(neg) OVER (ORDER BY threshold DESC) AS fp FROM per),
tot AS (SELECT sum(y_true) AS P, count(*) - sum(y_true) AS N FROM scored)
"""


@query("v2_roc_curve", _CURVE_SQL + """
SELECT round(threshold, 9) AS threshold, round(fp / N, 9) AS fpr, round(tp / P, 9) AS tpr FROM cum, tot
""")
def v2_roc_curve(spark, sf_dir):
    r = M.roc_curve(scored(Tables(spark, sf_dir)))
    return r.select(*[F.round(c, 9).alias(c) for c in ("threshold", "fpr", "tpr")])


@query("v2_pr_curve", _CURVE_SQL + """
SELECT round(threshold, 9) AS threshold, round(tp / (tp + fp), 9) AS precision, round(tp / P, 9) AS recall FROM cum, tot
""")
def v2_pr_curve(spark, sf_dir):
    r = M.pr_curve(scored(Tables(spark, sf_dir)))
    return r.select(*[F.round(c, 9).alias(c) for c in ("threshold", "precision", "recall")])


@query("v2_auc", _CURVE_SQL + """
, z AS (SELECT *, tp - pos AS tp0, fp - neg AS fp0 FROM cum)
SELECT round(sum((fp - fp0) * (tp + tp0) / 2.0) / any_value(P * N), 9) AS roc_auc,
       round(sum((tp - tp0) / P * (tp / (tp + fp) + CASE WHEN tp0 + fp0 > 0 THEN tp0 / (tp0 + fp0) ELSE 1.0 END) / 2.0), 9) AS pr_auc,
       round(sum((tp - tp0) / P * tp / (tp + fp)), 9) AS average_precision
FROM z, tot
""")
def v2_auc(spark, sf_dir):
    r = M.auc_summary(scored(Tables(spark, sf_dir)))
    return r.select(*[F.round(c, 9).alias(c) for c in ("roc_auc", "pr_auc", "average_precision")])


@query("v2_auc_rank", _CURVE_SQL + """
, z AS (SELECT *, tp - pos AS tp0, fp - neg AS fp0 FROM cum)
SELECT round(sum((fp - fp0) * (tp + tp0) / 2.0) / any_value(P * N), 9) AS roc_auc FROM z, tot
""")
def v2_auc_rank(spark, sf_dir):
    """Rank-sum AUC; equals the trapezoid AUC (the oracle is the trapezoid form)."""
    r = M.auc_rank(scored(Tables(spark, sf_dir)))
    return r.select(F.round("roc_auc", 9).alias("roc_auc"))


@query("v3_best_threshold", f"""
WITH {SCORED_SQL}, g AS (SELECT i, i / 999.0 AS threshold FROM range(0, 1000) r(i)),
c AS (SELECT g.threshold,
        500 * count(*) FILTER (WHERE s.y_true = 1 AND s.score < g.threshold)
      + 100 * count(*) FILTER (WHERE s.y_true = 0 AND s.score >= g.threshold)
      + 100 * count(*) FILTER (WHERE s.y_true = 1 AND s.score >= g.threshold) AS cost
      FROM g, scored s GROUP BY g.threshold)
SELECT round(threshold, 9) AS threshold, CAST(cost AS DOUBLE) AS cost FROM c ORDER BY cost, threshold LIMIT 1
""")
def v3_best_threshold(spark, sf_dir):
    r = M.best_threshold(scored(Tables(spark, sf_dir)))
    return r.select(F.round("threshold", 9).alias("threshold"), F.col("cost").cast("double").alias("cost"))


@query("v4_regression_metrics", """
WITH x AS (SELECT l_extendedprice AS a, l_quantity * 1500.0 AS p FROM lineitem)
SELECT round(avg(abs(a - p)), 4) AS mae, round(avg((a - p) * (a - p)), 2) AS mse, round(sqrt(avg((a - p) * (a - p))), 4) AS rmse,
       round(1 - sum((a - p) * (a - p)) / (var_pop(a) * count(*)), 9) AS r2,
       round(avg((ln(1 + a) - ln(1 + p)) * (ln(1 + a) - ln(1 + p))), 9) AS msle,
       round(sqrt(avg((ln(1 + a) - ln(1 + p)) * (ln(1 + a) - ln(1 + p)))), 9) AS rmsle
FROM x
""")
def v4_regression_metrics(spark, sf_dir):
    li = Tables(spark, sf_dir).lineitem.select(F.col("l_extendedprice").alias("actual"),
                                               (F.col("l_quantity") * 1500.0).alias("predicted"))
    r = M.regression_metrics(li)
    return r.select(F.round("mae", 4).alias("mae"), F.round("mse", 2).alias("mse"), F.round("rmse", 4).alias("rmse"),
                    F.round("r2", 9).alias("r2"), F.round("msle", 9).alias("msle"), F.round("rmsle", 9).alias("rmsle"))


@query("v5_loss_metrics", f"""
WITH {SCORED_SQL}, x AS (SELECT CAST(y_true AS DOUBLE) AS a, score AS p,
                                least(greatest(score, 1e-15), 1 - 1e-15) AS pc FROM scored)
SELECT round(avg(CAST(a <> p AS DOUBLE)), 9) AS classification_error,
       round(avg(-(a * ln(pc) + (1 - a) * ln(1 - pc))), 9) AS log_loss,
       round(avg(greatest(0.0, 1 - CASE WHEN a = 0 THEN -1.0 ELSE a END * p)), 9) AS hinge,
       round(sum(-(a * ln(pc) + (1 - a) * ln(1 - pc))), 6) AS bce_sum
FROM x
""")
def v5_loss_metrics(spark, sf_dir):
    s = scored(Tables(spark, sf_dir)).select(F.col("y_true").alias("actual"), F.col("score").alias("predicted"))
    r = M.loss_metrics(s)
    return r.select(*[F.round(c, 9).alias(c) for c in ("classification_error", "log_loss", "hinge")],
                    F.round("bce_sum", 6).alias("bce_sum"))


_FC_SQL = {
    "mse": "avg(e*e)", "rmse": "sqrt(avg(e*e))", "nrmse": "sqrt(avg(e*e)) / (max(a) - min(a))", "me": "avg(e)",
    "mae": "avg(abs(e))", "mad": "avg(abs(e))",
    "gmae": "CASE WHEN min(abs(e)) = 0 THEN 0.0 ELSE exp(avg(ln(abs(e)))) END",
    "mdae": "quantile_cont(abs(e), 0.5)", "mpe": "avg(pe)", "mape": "avg(abs(pe))",
    "mdape": "quantile_cont(abs(pe), 0.5)", "smape": "avg(2.0 * abs(e) / (abs(a) + abs(p) + 1e-10))",
    "smdape": "quantile_cont(2.0 * abs(e) / (abs(a) + abs(p) + 1e-10), 0.5)",
    "maape": "avg(atan(abs((a - p) / (a + 1e-10))))", "mase": "avg(abs(e)) / avg(abs(nd))",
    "std_ae": "sqrt((sum(e*e) - 2 * avg(abs(e)) * sum(e) + count(*) * avg(abs(e)) * avg(abs(e))) / (count(*) - 1))",
    "std_ape": "sqrt((sum(pe*pe) - 2 * avg(abs(pe)) * sum(pe) + count(*) * avg(abs(pe)) * avg(abs(pe))) / (count(*) - 1))",
    "rmspe": "sqrt(avg(pe*pe))", "rmdspe": "sqrt(quantile_cont(pe*pe, 0.5))",
    "rmsse": "sqrt(avg(e*e)) / avg(abs(nd))", "inrse": "sqrt(sum(e*e) / (var_pop(a) * count(*)))",
    "rrse": "sqrt(sum(e*e) / (var_pop(a) * count(*)))", "mre": "avg(e / (nd + 1e-10))",
    "rae": "sum(abs(e)) / (sum(abs(a - m)) + 1e-10)", "mrae": "avg(abs(e / (nd + 1e-10)))",
    "mdrae": "quantile_cont(abs(e / (nd + 1e-10)), 0.5)",
    "gmrae": "CASE WHEN min(abs(e / (nd + 1e-10))) = 0 THEN 0.0 ELSE exp(avg(ln(abs(e / (nd + 1e-10))))) END",
    "mbrae": "avg(abs(e) / (abs(e) + abs(nd) + 1e-10))",
    "umbrae": "avg(abs(e) / (abs(e) + abs(nd) + 1e-10)) / (1 - avg(abs(e) / (abs(e) + abs(nd) + 1e-10)))",
    "mda": "avg(CAST(dir AS DOUBLE))", "bias": "avg(e)", "r2": "1 - sum(e*e) / (var_pop(a) * count(*))",
}


@query("v6_forecast_metrics", f"""
WITH {DAILY_SQL},
f AS (SELECT series, day, actual AS a,
             avg(actual) OVER (PARTITION BY series ORDER BY day ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING) AS p FROM daily),
b0 AS (SELECT * FROM f WHERE a IS NOT NULL AND p IS NOT NULL),
b AS (SELECT *, a - p AS e, (a - p) / (a + 1e-10) AS pe, a - lag(a, 1) OVER w AS nd,
             sign(a - lag(a) OVER w) = sign(p - lag(p) OVER w) AS dir, avg(a) OVER (PARTITION BY series) AS m
      FROM b0 WINDOW w AS (PARTITION BY series ORDER BY day)),
wide AS (SELECT series, {", ".join(f"CAST({v} AS DOUBLE) AS {k}" for k, v in _FC_SQL.items())} FROM b GROUP BY series),
u AS (SELECT * FROM wide UNPIVOT INCLUDE NULLS (value FOR metric IN ({", ".join(_FC_SQL)})))
SELECT series, metric, round(value, 6) AS value FROM u
""")
def v6_forecast_metrics(spark, sf_dir):
    d = daily(Tables(spark, sf_dir))
    w = Window.partitionBy("series").orderBy("day").rowsBetween(-7, -1)
    d = d.withColumn("predicted", F.avg("actual").over(w))
    r = M.forecast_metrics(d, "series", "day", "actual", "predicted")
    return r.select("series", "metric", F.round("value", 6).alias("value"))


_IOU_SRC = "SELECT l_linenumber - 1 AS t, CAST(floor(l_quantity / 7) AS INTEGER) AS p FROM lineitem"


def _iou(spark, sf_dir):
    li = Tables(spark, sf_dir).lineitem.select((F.col("l_linenumber") - 1).alias("t"),
                                               F.floor(F.col("l_quantity") / 7).cast("int").alias("p"))
    return M.iou(li, "t", "p", 7)


_IOU_SQL = f"""
WITH s AS ({_IOU_SRC}), cm AS (SELECT t, p, count(*) AS n FROM s WHERE t < 7 AND p < 7 GROUP BY t, p),
cls AS (SELECT CAST(i AS INTEGER) AS cls FROM range(0, 7) r(i)),
per AS (SELECT cls, coalesce((SELECT sum(n) FROM cm WHERE t = cls AND p = cls), 0) AS inter,
               coalesce((SELECT sum(n) FROM cm WHERE t = cls), 0) AS "row", coalesce((SELECT sum(n) FROM cm WHERE p = cls), 0) AS col
        FROM cls)
"""


@query("v7_iou", _IOU_SQL + 'SELECT cls, round(inter / ("row" + col - inter + 1e-8), 9) AS iou FROM per')
def v7_iou(spark, sf_dir):
    per, _ = _iou(spark, sf_dir)
    return per.withColumn("iou", F.round("iou", 9))


@query("v7_iou_summary", _IOU_SQL + """
SELECT round(avg(CASE WHEN cls >= 1 THEN inter / ("row" + col - inter + 1e-8) END), 9) AS mean_iou,
       round(sum(inter) / (sum("row") + 1e-8), 9) AS pixel_accuracy FROM per
""")
def v7_iou_summary(spark, sf_dir):
    _, s = _iou(spark, sf_dir)
    return s.select(F.round("mean_iou", 9).alias("mean_iou"), F.round("pixel_accuracy", 9).alias("pixel_accuracy"))


@query("v8_divergence", """
WITH a AS (SELECT event_type AS k, count(*) / (SELECT count(*) FROM events WHERE ts < TIMESTAMP '2024-01-16') AS p
           FROM events WHERE ts < TIMESTAMP '2024-01-16' GROUP BY 1),
b AS (SELECT event_type AS k, count(*) / (SELECT count(*) FROM events WHERE ts >= TIMESTAMP '2024-01-16') AS q
      FROM events WHERE ts >= TIMESTAMP '2024-01-16' GROUP BY 1),
j AS (SELECT coalesce(a.p, 0) AS p, coalesce(b.q, 0) AS q FROM a FULL JOIN b USING (k))
SELECT round(sum(CASE WHEN p > 0 THEN p * ln(p / q) ELSE 0 END), 9) AS kl,
       round(0.5 * sum(CASE WHEN p > 0 THEN p * ln(p / ((p + q) / 2)) ELSE 0 END)
           + 0.5 * sum(CASE WHEN q > 0 THEN q * ln(q / ((p + q) / 2)) ELSE 0 END), 9) AS js,
       round(sqrt(0.5 * sum(power(sqrt(p) - sqrt(q), 2))), 9) AS hellinger FROM j
""")
def v8_divergence(spark, sf_dir):
    e = Tables(spark, sf_dir).events
    cut = F.lit("2024-01-16 00:00:00").cast("timestamp_ntz")
    p = M.distribution(e.where(F.col("ts") < cut), "event_type")
    q = M.distribution(e.where(F.col("ts") >= cut), "event_type")
    r = M.divergence(p, q)
    return r.select(*[F.round(c, 9).alias(c) for c in ("kl", "js", "hellinger")])


@query("v9_rate_estimates", """
SELECT quality, count(*) AS n, CAST(sum(toxic) AS BIGINT) AS heads, round(avg(toxic), 9) AS mle,
       round((sum(toxic) + 6) / (count(*) + 10), 9) AS map FROM labels GROUP BY quality
""")
def v9_rate_estimates(spark, sf_dir):
    r = M.rate_estimates(Tables(spark, sf_dir).labels, "quality", "toxic", 6, 4)
    return r.select("quality", "n", F.col("heads").cast("long").alias("heads"), F.round("mle", 9).alias("mle"),
                    F.round("map", 9).alias("map"))


@query("v9_rate_estimates_events", """
SELECT user_id, count(*) AS n, CAST(sum(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END) AS BIGINT) AS heads,
       round(avg(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END), 9) AS mle,
       round((sum(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END) + 1) / (count(*) + 2), 9) AS map
FROM events GROUP BY user_id
""")
def v9_rate_estimates_events(spark, sf_dir):
    e = Tables(spark, sf_dir).events.withColumn("bought", (F.col("event_type") == "purchase").cast("int"))
    r = M.rate_estimates(e, "user_id", "bought", 1, 1)
    return r.select("user_id", "n", F.col("heads").cast("long").alias("heads"), F.round("mle", 9).alias("mle"),
                    F.round("map", 9).alias("map"))


@query("v10_bayes_factor", """
WITH c AS (SELECT quality, CAST(count(*) AS DOUBLE) AS n, CAST(sum(toxic) AS DOUBLE) AS heads FROM labels GROUP BY quality)
SELECT quality, n, heads, round(n * ln(0.5), 6) AS log_evidence_fair,
       round(((heads + 1) + (n - heads + 1) - 2) * ln(0.5) - (lgamma(heads + 1) + lgamma(n - heads + 1) - lgamma(n + 2))
             - (0 * ln(0.5) - (lgamma(1) + lgamma(1) - lgamma(2))), 6) AS log_savage_dickey
FROM c
""")
def v10_bayes_factor(spark, sf_dir):
    r = M.bayes_factor(Tables(spark, sf_dir).labels, "quality", "toxic")
    return r.select("quality", "n", "heads", F.round("log_evidence_fair", 6).alias("log_evidence_fair"),
                    F.round("log_savage_dickey", 6).alias("log_savage_dickey"))
