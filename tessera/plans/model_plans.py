"""Feature, model, clustering, vector and sampling queries (G, M, K, T17-T21, Q)."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from tessera.functions import text as FT
from tessera.operators import cluster as K
from tessera.operators import features as G
from tessera.operators import models as M
from tessera.operators import sampling as S
from tessera.operators import vectors as V
from tessera.plans.registry import query
from tessera.session import Tables, cut_lineage

PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]


# ---------------------------------------------------------------- G: features

@query("g1_one_hot", "SELECT o_orderkey, " + ", ".join(
    f"coalesce(CAST(o_orderpriority = '{p}' AS INTEGER), 0) AS \"o_orderpriority_{p}\"" for p in PRIORITIES)
    + " FROM orders")
def g1_one_hot(spark, sf_dir):
    o = Tables(spark, sf_dir).orders.select("o_orderkey", "o_orderpriority")
    return G.one_hot(o, ["o_orderpriority"])


@query("g2_graph_features", """
SELECT o_orderkey, coalesce(CAST(o_orderstatus = 'F' AS INTEGER), 0) AS o_orderstatus_F,
       coalesce(CAST(o_orderstatus = 'O' AS INTEGER), 0) AS o_orderstatus_O,
       coalesce(CAST(o_orderstatus = 'P' AS INTEGER), 0) AS o_orderstatus_P,
       round(log10(o_totalprice), 9) AS o_totalprice FROM orders
""")
def g2_graph_features(spark, sf_dir):
    o = Tables(spark, sf_dir).orders
    feats, _ = G.graph_features(o, "o_orderkey", ["o_orderstatus"], "o_totalprice", "o_orderpriority")
    return feats.withColumn("o_totalprice", F.round("o_totalprice", 9))


@query("g3_keep_top_categories", """
WITH top AS (SELECT p_brand FROM part GROUP BY p_brand ORDER BY count(*) DESC, p_brand LIMIT 5)
SELECT CASE WHEN p_brand IN (SELECT p_brand FROM top) THEN p_brand ELSE 'Other' END AS p_brand, count(*) AS n
FROM part GROUP BY 1
""")
def g3_keep_top_categories(spark, sf_dir):
    r = G.keep_top_categories(Tables(spark, sf_dir).part.select("p_partkey", "p_brand"), "p_brand", 5)
    return r.groupBy("p_brand").agg(F.count(F.lit(1)).alias("n"))


@query("g4_dict_vectorize")
def g4_dict_vectorize(spark, sf_dir):
    p = Tables(spark, sf_dir).part.select("p_partkey", "p_brand", "p_type")
    from pyspark.ml.functions import vector_to_array
    out = G.dict_vectorize(p, ["p_brand", "p_type"]).transform(p)
    return out.select("p_partkey", F.size(vector_to_array("features")).alias("dim"),
                      F.aggregate(vector_to_array("features"), F.lit(0.0), lambda a, x: a + x).alias("nnz"))


@query("g5_hash_features")
def g5_hash_features(spark, sf_dir):
    p = Tables(spark, sf_dir).part.select("p_partkey", "p_brand", "p_type", "p_size")
    out = G.hash_features(p, ["p_brand", "p_type", "p_size"], 64)
    return out.select("p_partkey", F.explode("features").alias("bucket", "value"))


@query("g6_standardize", """
SELECT l_orderkey, l_linenumber, l_partkey,
  round((l_quantity - avg(l_quantity) OVER ()) / (stddev_pop(l_quantity) OVER () + 1e-6), 9) AS l_quantity,
  round((l_discount - avg(l_discount) OVER ()) / (stddev_pop(l_discount) OVER () + 1e-6), 9) AS l_discount FROM lineitem
""")
def g6_standardize(spark, sf_dir):
    li = Tables(spark, sf_dir).lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_discount")
    r = G.standardize(li, ["l_quantity", "l_discount"], eps=1e-6)
    return r.select("l_orderkey", "l_linenumber", "l_partkey", F.round("l_quantity", 9).alias("l_quantity"),
                    F.round("l_discount", 9).alias("l_discount"))


@query("g7_minmax", """
SELECT l_orderkey, l_linenumber, l_partkey,
  round((l_quantity - min(l_quantity) OVER ()) / (max(l_quantity) OVER () - min(l_quantity) OVER ()), 9) AS l_quantity,
  round((l_tax - min(l_tax) OVER ()) / (max(l_tax) OVER () - min(l_tax) OVER ()), 9) AS l_tax FROM lineitem
""")
def g7_minmax(spark, sf_dir):
    li = Tables(spark, sf_dir).lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_tax")
    r = G.minmax(li, ["l_quantity", "l_tax"])
    return r.select("l_orderkey", "l_linenumber", "l_partkey", F.round("l_quantity", 9).alias("l_quantity"),
                    F.round("l_tax", 9).alias("l_tax"))


def _lineitem_model_frame(spark, sf_dir):
    t = Tables(spark, sf_dir)
    li = t.lineitem.join(t.part.select(F.col("p_partkey").alias("l_partkey"), "p_type", "p_size"), "l_partkey")
    return li.select("l_orderkey", "l_linenumber", "l_partkey", "l_returnflag", "p_type", "l_linestatus", "l_quantity", "l_discount", "l_tax",
                     F.when(F.col("l_returnflag") == "R", None).otherwise(F.col("p_size").cast("double")).alias("size"),
                     F.log("l_extendedprice").alias("log_price"),
                     (F.col("l_returnflag") == "R").cast("double").alias("is_r"))


def _fit_frame(spark, sf_dir, *columns):
    """``columns`` of the lineitem frame, joined once: every fit and score reads the kept rows (in the join's own order)."""
    return cut_lineage(_lineitem_model_frame(spark, sf_dir).select(*columns))


@query("g8_tabular_pipeline")
def g8_tabular_pipeline(spark, sf_dir):
    """Pipeline fitted on the train part only, applied to the test part."""
    d = _lineitem_model_frame(spark, sf_dir).withColumn("_k", F.concat_ws("|", "l_orderkey", "l_linenumber", "l_partkey"))
    train, test = S.split_hash(d, "_k", 0.8, "tab")
    model = G.fit_tabular(train, ["p_type", "l_linestatus"], ["l_quantity", "size"])
    from pyspark.ml.functions import vector_to_array
    out = model.transform(test)
    return out.select("l_orderkey", "l_linenumber", "l_partkey", vector_to_array("features").alias("features"))


@query("g9_assemble")
def g9_assemble(spark, sf_dir):
    li = Tables(spark, sf_dir).lineitem
    from pyspark.ml.functions import vector_to_array
    return G.assemble(li, ["l_quantity", "l_discount", "l_tax"]).select(
        "l_orderkey", "l_linenumber", vector_to_array("features").alias("features"))


@query("g10_pca")
def g10_pca(spark, sf_dir):
    """Top-3 principal axes of the embeddings; projection and reconstruction error per vector."""
    e = Tables(spark, sf_dir).embeddings
    model = G.pca_fit(e, "embedding", 3)
    p = G.pca_project(e.withColumn("embedding", F.col("embedding").cast("array<double>")), "embedding", model)
    r = G.pca_inverse(p, "pca", model)
    err = F.sqrt(F.aggregate(F.zip_with("embedding", "reconstructed", lambda a, b: (a - b) * (a - b)), F.lit(0.0),
                             lambda s, x: s + x))
    return r.select("vec_id", "pca", err.alias("reconstruction_error"))


@query("g11_fisher_lda")
def g11_fisher_lda(spark, sf_dir):
    e = Tables(spark, sf_dir).embeddings
    m = G.fisher_lda(e, "embedding", "label", 2)
    rows = [(i, float(v)) for i, v in enumerate(m["eigenvalues"])]
    return spark.createDataFrame(rows, "axis int, eigenvalue double")


@query("g12_info_gain", """
WITH s AS (SELECT o_orderstatus AS target, o_orderpriority AS a1, CAST(year(o_orderdate) AS VARCHAR) AS a2 FROM orders),
h AS (SELECT -sum(p * log2(p)) AS h FROM (SELECT count(*) / (SELECT count(*) FROM s) AS p FROM s GROUP BY target)),
l AS (SELECT 'o_orderpriority' AS attr, a1 AS value, target FROM s UNION ALL SELECT 'year', a2, target FROM s),
c AS (SELECT attr, value, target, count(*) AS n FROM l GROUP BY ALL),
v AS (SELECT attr, value, sum(n) AS nv, -sum(n / nv_ * log2(n / nv_)) AS hv
      FROM (SELECT *, sum(n) OVER (PARTITION BY attr, value) AS nv_ FROM c) GROUP BY attr, value)
SELECT attr, round((SELECT h FROM h) - sum(nv / (SELECT count(*) FROM s) * hv), 9) AS gain FROM v GROUP BY attr
""")
def g12_info_gain(spark, sf_dir):
    o = Tables(spark, sf_dir).orders.select(F.col("o_orderstatus").alias("target"), "o_orderpriority",
                                            F.year("o_orderdate").cast("string").alias("year"))
    r = G.info_gain(o, ["o_orderpriority", "year"], "target")
    return r.withColumn("gain", F.round("gain", 9))


@query("g13_select_from_model")
def g13_select_from_model(spark, sf_dir):
    li = Tables(spark, sf_dir).lineitem
    return G.select_from_model(li, ["l_quantity", "l_discount", "l_tax"], "l_extendedprice", reg=10.0)


# ---------------------------------------------------------------- M: models

@query("m1_fraud_pipeline")
def m1_fraud_pipeline(spark, sf_dir):
    """Assembler + random forest (20 trees, depth 5) fitted on 70 % of lineitem, accuracy on the rest."""
    d = _lineitem_model_frame(spark, sf_dir).withColumn("_k", F.concat_ws("|", "l_orderkey", "l_linenumber", "l_partkey"))
    train, test = S.split_hash(d, "_k", 0.7, "rf")
    model = M.fraud_pipeline(["l_quantity", "l_discount", "l_tax", "log_price"], label="is_r").fit(train)
    pred = model.transform(test)
    return pred.agg(F.count(F.lit(1)).alias("n_test"),
                    F.avg((F.col("prediction") == F.col("is_r")).cast("double")).alias("accuracy"))


@query("m2_ridge", """
WITH a AS (SELECT avg(l_quantity) AS mx, avg(l_extendedprice) AS my,
                  covar_pop(l_quantity, l_extendedprice) * count(*) AS sxy, var_pop(l_quantity) * count(*) AS sxx FROM lineitem)
SELECT round(sxy / (sxx + 1.0), 6) AS slope, round(my - sxy / (sxx + 1.0) * mx, 4) AS intercept FROM a
""")
def m2_ridge(spark, sf_dir):
    r = M.ridge_fit(Tables(spark, sf_dir).lineitem, ["l_quantity"], "l_extendedprice", 1.0)
    return spark.createDataFrame([(round(r["coef"]["l_quantity"], 6), round(r["intercept"], 4))],
                                 "slope double, intercept double")


@query("m3_gradient_step", """
SELECT round(avg(2 * (0.5 + 0.001 * l_quantity - l_extendedprice / 1000) * 1), 9) AS g_bias,
       round(avg(2 * (0.5 + 0.001 * l_quantity - l_extendedprice / 1000) * l_quantity), 9) AS g_quantity FROM lineitem
""")
def m3_gradient_step(spark, sf_dir):
    li = Tables(spark, sf_dir).lineitem.select(F.lit(1.0).alias("bias"), "l_quantity",
                                               (F.col("l_extendedprice") / 1000).alias("y"))
    g = M.mse_gradient(li, ["bias", "l_quantity"], "y", [0.5, 0.001])
    return spark.createDataFrame([(round(g[0], 9), round(g[1], 9))], "g_bias double, g_quantity double")


@query("m3_logistic_regression")
def m3_logistic_regression(spark, sf_dir):
    """MLlib logistic regression (LBFGS) on lineitem features; test accuracy."""
    from pyspark.ml.classification import LogisticRegression
    d = G.assemble(_lineitem_model_frame(spark, sf_dir), ["l_quantity", "l_discount", "l_tax", "log_price"])
    d = d.withColumn("_k", F.concat_ws("|", "l_orderkey", "l_linenumber", "l_partkey"))
    train, test = S.split_hash(d, "_k", 0.7, "lr")
    m = LogisticRegression(labelCol="is_r").fit(train)
    return m.transform(test).agg(F.avg((F.col("prediction") == F.col("is_r")).cast("double")).alias("accuracy"))


@query("m5_linear_svm")
def m5_linear_svm(spark, sf_dir):
    d = G.assemble(_lineitem_model_frame(spark, sf_dir), ["l_quantity", "l_discount", "l_tax", "log_price"])
    m = M.linear_svm(d, "features", "is_r")
    return m.transform(d).agg(F.avg((F.col("prediction") == F.col("is_r")).cast("double")).alias("accuracy"))


_NB_X = ["l_quantity", "l_discount", "l_tax"]


@query("m6_gaussian_nb_params", "SELECT l_returnflag, round(count(*) / (SELECT count(*) FROM lineitem), 9) AS prior, "
       "feature, round(mean, 9) AS mean, round(var, 9) AS var FROM (" + " UNION ALL ".join(
           f"SELECT l_returnflag, '{x}' AS feature, avg({x}) AS mean, var_pop({x}) AS var, count(*) AS c FROM lineitem "
           "GROUP BY l_returnflag" for x in _NB_X) + ") q JOIN lineitem USING (l_returnflag) GROUP BY l_returnflag, feature, mean, var")
def m6_gaussian_nb_params(spark, sf_dir):
    p = M.gaussian_nb_fit(Tables(spark, sf_dir).lineitem, _NB_X, "l_returnflag")
    return p.select("l_returnflag", F.round("prior", 9).alias("prior"), "feature", F.round("mean", 9).alias("mean"),
                    F.round("var", 9).alias("var"))


@query("m6_gaussian_nb_predict")
def m6_gaussian_nb_predict(spark, sf_dir):
    li = Tables(spark, sf_dir).lineitem.withColumn("_k", F.concat_ws("|", "l_orderkey", "l_linenumber", "l_partkey"))
    params = M.gaussian_nb_fit(li, _NB_X, "l_returnflag")
    pred = M.gaussian_nb_predict(li, _NB_X, "l_returnflag", params, "_k")
    return pred.groupBy("pred").agg(F.count(F.lit(1)).alias("n"))


def _emb_split(spark, sf_dir):
    e = Tables(spark, sf_dir).embeddings.select(F.col("vec_id").alias("id"), F.col("embedding").alias("vec"), "label")
    return S.split_hash(e, "id", 0.8, "knn")


@query("m7_knn_classify", """
WITH e AS (SELECT vec_id AS id, embedding AS vec, label, substr(md5(CAST(vec_id AS VARCHAR) || 'knn'), 1, 8) < 'cccccccc' AS tr
           FROM embeddings),
d AS (SELECT q.id AS qid, c.id AS cid, c.label,
             list_sum(list_transform(list_zip(q.vec, c.vec), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS d2
      FROM e q, e c WHERE NOT q.tr AND c.tr),
r AS (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY d2, cid) AS rk FROM d),
v AS (SELECT qid, label, count(*) AS n FROM r WHERE rk <= 5 GROUP BY qid, label)
SELECT qid AS id, label AS pred FROM (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY n DESC, label) AS w FROM v) WHERE w = 1
""")
def m7_knn_classify(spark, sf_dir):
    train, test = _emb_split(spark, sf_dir)
    return V.knn_classify(train, test, 5)


_SPLIT_FEATS = ["l_quantity", "l_discount", "l_tax"]


def _split_sql(crit):
    unions = " UNION ALL ".join(f"SELECT {i} AS fi, '{f}' AS feature, {f} AS x, l_returnflag AS y FROM lineitem"
                                for i, f in enumerate(_SPLIT_FEATS))
    return f"""
WITH l AS ({unions}),
per AS (SELECT fi, feature, x, count(*) FILTER (WHERE y = 'A') AS a, count(*) FILTER (WHERE y = 'N') AS b,
               count(*) FILTER (WHERE y = 'R') AS c FROM l GROUP BY ALL),
cum AS (SELECT *, sum(a) OVER w AS la, sum(b) OVER w AS lb, sum(c) OVER w AS lc,
               sum(a) OVER (PARTITION BY fi) AS ta, sum(b) OVER (PARTITION BY fi) AS tb, sum(c) OVER (PARTITION BY fi) AS tc,
               lead(x) OVER (PARTITION BY fi ORDER BY x) AS xn
        FROM per WINDOW w AS (PARTITION BY fi ORDER BY x ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
g AS (SELECT *, la + lb + lc AS nl, ta + tb + tc AS nt, (ta + tb + tc) - (la + lb + lc) AS nr FROM cum),
e AS (SELECT *,
  -(CASE WHEN ta > 0 THEN ta / nt * {crit}(ta / nt) ELSE 0 END + CASE WHEN tb > 0 THEN tb / nt * {crit}(tb / nt) ELSE 0 END
    + CASE WHEN tc > 0 THEN tc / nt * {crit}(tc / nt) ELSE 0 END) AS hp,
  -(CASE WHEN la > 0 THEN la / nl * {crit}(la / nl) ELSE 0 END + CASE WHEN lb > 0 THEN lb / nl * {crit}(lb / nl) ELSE 0 END
    + CASE WHEN lc > 0 THEN lc / nl * {crit}(lc / nl) ELSE 0 END) AS hl,
  CASE WHEN nr > 0 THEN -(CASE WHEN ta - la > 0 THEN (ta - la) / nr * {crit}((ta - la) / nr) ELSE 0 END
    + CASE WHEN tb - lb > 0 THEN (tb - lb) / nr * {crit}((tb - lb) / nr) ELSE 0 END
    + CASE WHEN tc - lc > 0 THEN (tc - lc) / nr * {crit}((tc - lc) / nr) ELSE 0 END) ELSE 0 END AS hr FROM g),
s AS (SELECT feature, fi, {'x' if crit == 'log2' else '(x + xn) / 2.0'} AS threshold,
             CASE WHEN nl = 0 OR nr = 0 THEN 0.0 ELSE hp - (nl / nt * hl + nr / nt * hr) END AS gain
      FROM e {'' if crit == 'log2' else 'WHERE xn IS NOT NULL'})
SELECT feature, round(threshold, 9) AS threshold, round(gain, 9) AS gain FROM s ORDER BY gain DESC, fi, threshold LIMIT 1
"""


@query("m8_best_split", _split_sql("log2"))
def m8_best_split(spark, sf_dir):
    r = M.best_split(Tables(spark, sf_dir).lineitem, _SPLIT_FEATS, "l_returnflag", "bits")
    return r.select("feature", F.round("threshold", 9).alias("threshold"), F.round("gain", 9).alias("gain"))


@query("m8_best_split_nats", _split_sql("ln"))
def m8_best_split_nats(spark, sf_dir):
    r = M.best_split(Tables(spark, sf_dir).lineitem, _SPLIT_FEATS, "l_returnflag", "nats")
    return r.select("feature", F.round("threshold", 9).alias("threshold"), F.round("gain", 9).alias("gain"))


def _grad_sql(gain: str, where: str, threshold: str) -> str:
    unions = " UNION ALL ".join(f"SELECT {i} AS fi, '{f}' AS feature, {f} AS x, l_extendedprice / 1000 AS y FROM lineitem"
                                for i, f in enumerate(_SPLIT_FEATS))
    return f"""
WITH l AS ({unions}),
per AS (SELECT fi, feature, x, sum(y) AS sy, sum(y * y) AS sq, count(*) AS n FROM l GROUP BY ALL),
cum AS (SELECT *, sum(sy) OVER w AS ls, sum(sq) OVER w AS lq, sum(n) OVER w AS ln_, sum(sy) OVER p AS ts, sum(sq) OVER p AS tq,
               sum(n) OVER p AS tn, lead(x) OVER (PARTITION BY fi ORDER BY x) AS xn
        FROM per WINDOW w AS (PARTITION BY fi ORDER BY x ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), p AS (PARTITION BY fi))
SELECT feature, round({threshold}, 9) AS threshold, round({gain}, 4) AS gain FROM cum {where}
ORDER BY {gain} DESC, fi, {threshold} LIMIT 1
"""


# squared loss at prediction 0: gradient -y, curvature 1, so G = -sum(y) and H = n
@query("m8_best_split_second_order", _grad_sql(
    "0.5 * (ls * ls / (ln_ + 1.0) + (ts - ls) * (ts - ls) / (tn - ln_ + 1.0) - ts * ts / (tn + 1.0))", "", "x"))
def m8_best_split_second_order(spark, sf_dir):
    li = Tables(spark, sf_dir).lineitem.select(*_SPLIT_FEATS, (-F.col("l_extendedprice") / 1000).alias("g"), F.lit(1.0).alias("h"))
    r = M.best_split(li, _SPLIT_FEATS, "g", "xgb", lam=1.0)
    return r.select("feature", F.round("threshold", 9).alias("threshold"), F.round("gain", 4).alias("gain"))


@query("m8_best_split_parent_mean", _grad_sql(
    "-((lq - 2 * (ts / tn) * ls + ln_ * (ts / tn) * (ts / tn)) * ln_ / tn"
    " + ((tq - lq) - 2 * (ts / tn) * (ts - ls) + (tn - ln_) * (ts / tn) * (ts / tn)) * (tn - ln_) / tn)",
    "WHERE xn IS NOT NULL", "((x + xn) / 2.0)"))
def m8_best_split_parent_mean(spark, sf_dir):
    li = Tables(spark, sf_dir).lineitem.select(*_SPLIT_FEATS, (F.col("l_extendedprice") / 1000).alias("y"))
    r = M.best_split(li, _SPLIT_FEATS, "y", "mse_parent")
    return r.select("feature", F.round("threshold", 9).alias("threshold"), F.round("gain", 4).alias("gain"))


@query("m13_knn_regress", """
WITH e AS (SELECT vec_id AS id, embedding AS vec, label::DOUBLE AS y, substr(md5(CAST(vec_id AS VARCHAR) || 'knn'), 1, 8) < 'cccccccc' AS tr
           FROM embeddings),
d AS (SELECT q.id AS qid, c.id AS cid, c.y,
             list_sum(list_transform(list_zip(q.vec, c.vec), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS d2
      FROM e q, e c WHERE NOT q.tr AND c.tr),
r AS (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY d2, cid) AS rk FROM d)
SELECT qid AS id, round(avg(y), 9) AS pred FROM r WHERE rk <= 5 GROUP BY qid
""")
def m13_knn_regress(spark, sf_dir):
    train, test = _emb_split(spark, sf_dir)
    r = V.knn_regress(train.withColumn("y", F.col("label").cast("double")), test, 5)
    return r.select("id", F.round("pred", 9).alias("pred"))


@query("m3_logistic_gd")
def m3_logistic_gd(spark, sf_dir):
    """25 full-batch steps on returned vs other lines; the log loss falls below that of the zero start."""
    li = Tables(spark, sf_dir).lineitem.select(
        (F.col("l_quantity") / 50).alias("q"), (F.col("l_discount") * 10).alias("d"), (F.col("l_returnflag") == "R").cast("double").alias("y"))
    theta = M.logistic_gd(li, ["q", "d"], "y", lr=0.5, iters=25)
    z = F.lit(float(theta[0])) + float(theta[1]) * F.col("q") + float(theta[2]) * F.col("d")
    p = 1 / (1 + F.exp(-z))
    return li.agg(F.avg(-(F.col("y") * F.log(p) + (1 - F.col("y")) * F.log(1 - p))).alias("log_loss")).select(
        F.lit(float(theta[0])).alias("bias"), F.lit(float(theta[1])).alias("q"), F.lit(float(theta[2])).alias("d"), "log_loss")


@query("m8_best_split_mse", """
WITH l AS (SELECT 0 AS fi, 'l_quantity' AS feature, l_quantity AS x, l_extendedprice / 1000 AS y FROM lineitem
           UNION ALL SELECT 1, 'l_discount', l_discount, l_extendedprice / 1000 FROM lineitem),
per AS (SELECT fi, feature, x, count(*) AS n, sum(y) AS sy, sum(y * y) AS sq FROM l GROUP BY ALL),
cum AS (SELECT *, sum(n) OVER w AS ln_, sum(sy) OVER w AS ls, sum(sq) OVER w AS lq,
               sum(n) OVER (PARTITION BY fi) AS tn, sum(sy) OVER (PARTITION BY fi) AS ts, sum(sq) OVER (PARTITION BY fi) AS tq,
               lead(x) OVER (PARTITION BY fi ORDER BY x) AS xn
        FROM per WINDOW w AS (PARTITION BY fi ORDER BY x ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
s AS (SELECT feature, fi, (x + xn) / 2.0 AS threshold,
             (tq - ts * ts / tn) - (lq - ls * ls / ln_) - ((tq - lq) - (ts - ls) * (ts - ls) / (tn - ln_)) AS gain
      FROM cum WHERE xn IS NOT NULL)
SELECT feature, round(threshold, 9) AS threshold, round(gain, 6) AS gain FROM s ORDER BY gain DESC, fi, threshold LIMIT 1
""")
def m8_best_split_mse(spark, sf_dir):
    li = Tables(spark, sf_dir).lineitem.withColumn("y", F.col("l_extendedprice") / 1000)
    r = M.best_split(li, ["l_quantity", "l_discount"], "y", "mse")
    return r.select("feature", F.round("threshold", 9).alias("threshold"), F.round("gain", 6).alias("gain"))


@query("m9_tree_models")
def m9_tree_models(spark, sf_dir):
    feats = ["l_quantity", "l_discount", "l_tax", "log_price"]
    d = G.assemble(_fit_frame(spark, sf_dir, *feats, "is_r"), feats)
    rows = []
    for kind in ("tree", "forest", "gbt"):
        m = M.tree_models(kind, "is_r", maxDepth=4, **({"maxIter": 10} if kind == "gbt" else {})).fit(d)
        acc = m.transform(d).agg(F.avg((F.col("prediction") == F.col("is_r")).cast("double"))).first()[0]
        rows.append((kind, float(acc)))
    return spark.createDataFrame(rows, "model string, train_accuracy double")


@query("m10_id3")
def m10_id3(spark, sf_dir):
    o = Tables(spark, sf_dir).orders.select("o_orderpriority", "o_orderstatus",
                                            F.year("o_orderdate").cast("string").alias("year"))
    return M.id3(o, ["o_orderpriority", "year"], "o_orderstatus", max_depth=2)


@query("m11_adaboost")
def m11_adaboost(spark, sf_dir):
    li = _lineitem_model_frame(spark, sf_dir).withColumn(
        "_k", F.concat_ws("|", "l_orderkey", "l_linenumber", "l_partkey")).withColumn(
        "y", F.when(F.col("is_r") == 1, 1.0).otherwise(-1.0))
    learners = M.adaboost(li, "_k", ["l_quantity", "l_discount", "log_price"], "y", rounds=3)
    pred = li.select((M.adaboost_predict(li, learners) == F.col("y")).cast("double").alias("ok"))
    return pred.agg(F.avg("ok").alias("train_accuracy"), F.lit(len(learners)).alias("n_learners"))


@query("m12_boost_stumps")
def m12_boost_stumps(spark, sf_dir):
    li = _lineitem_model_frame(spark, sf_dir).withColumn(
        "_k", F.concat_ws("|", "l_orderkey", "l_linenumber", "l_partkey"))
    model = M.boost_stumps(li, "_k", ["l_quantity", "l_discount"], "log_price", rounds=3, lr=0.1)
    p = li.select((F.col("log_price") - M.boost_predict(model)).alias("e"))
    return p.agg(F.avg(F.col("e") * F.col("e")).alias("train_mse"))


@query("m13_compare_regressors")
def m13_compare_regressors(spark, sf_dir):
    feats = ["l_quantity", "l_discount", "l_tax"]
    keyed = _lineitem_model_frame(spark, sf_dir).withColumn("_k", F.concat_ws("|", "l_orderkey", "l_linenumber", "l_partkey"))
    train, test = (G.assemble(cut_lineage(part.select(*feats, "log_price")), feats) for part in S.split_hash(keyed, "_k", 0.8, "reg"))
    return M.compare_regressors(train, test, "features", "log_price")


@query("m14_gbt_fraud")
def m14_gbt_fraud(spark, sf_dir):
    d = G.assemble(_lineitem_model_frame(spark, sf_dir), ["l_quantity", "l_discount", "l_tax", "log_price"])
    d = d.withColumn("_k", F.concat_ws("|", "l_orderkey", "l_linenumber", "l_partkey"))
    d = d.withColumn("is_valid", S.hash_key("_k", "gbt") >= "e6666666")
    m = M.gbt_fraud(d, "features", "is_r", valid_col="is_valid")
    return m.transform(d).agg(F.avg((F.col("prediction") == F.col("is_r")).cast("double")).alias("accuracy"),
                              F.lit(m.getNumTrees).alias("n_trees"))


@query("m15_score_batches")
def m15_score_batches(spark, sf_dir):
    d = G.assemble(_lineitem_model_frame(spark, sf_dir), ["l_quantity", "l_discount", "l_tax", "log_price"])
    m = M.tree_models("tree", "is_r", maxDepth=3).fit(d)
    return M.score_batches(d, m, 500).select("l_orderkey", "l_linenumber", "prediction")


@query("m16_ordinal", """
SELECT o_orderkey, array_to_string([CAST(r > 0 AS INTEGER), CAST(r > 1 AS INTEGER), CAST(r > 2 AS INTEGER), CAST(r > 3 AS INTEGER)], ' ')
       AS bits, CAST(r AS INTEGER) AS decoded
FROM (SELECT o_orderkey, CAST(left(o_orderpriority, 1) AS INTEGER) - 1 AS r FROM orders)
""")
def m16_ordinal(spark, sf_dir):
    o = Tables(spark, sf_dir).orders.select(
        "o_orderkey", (F.substring("o_orderpriority", 1, 1).cast("int") - 1).alias("r"))
    enc = o.select("o_orderkey", M.ordinal_encode("r", 5).alias("b"))
    dec = enc.select("o_orderkey", F.array_join("b", " ").alias("bits"),
                     M.ordinal_decode(F.transform("b", lambda x: x.cast("double"))).alias("decoded"))
    return dec


@query("q11_search")
def q11_search(spark, sf_dir):
    from pyspark.ml.evaluation import RegressionEvaluator
    from pyspark.ml.regression import LinearRegression
    feats = ["l_quantity", "l_discount", "l_tax"]
    d = G.assemble(_fit_frame(spark, sf_dir, *feats, "log_price"), feats).select("features", "log_price")
    lr = LinearRegression(featuresCol="features", labelCol="log_price")
    grid = {lr.regParam: [0.0, 0.1, 1.0], lr.elasticNetParam: [0.0, 0.5, 1.0]}
    ev = RegressionEvaluator(labelCol="log_price", metricName="rmse")
    full = M.search(lr, grid, ev, d)
    rnd = M.search(lr, grid, ev, d, random=3, seed=7)
    drawn = M.search(lr, {lr.regParam: (0.0, 1.0), lr.elasticNetParam: [0.0, 0.5]}, ev, d, random=3, seed=7)
    rows = [("grid", len(full.validationMetrics), float(min(full.validationMetrics))),
            ("random", len(rnd.validationMetrics), float(min(rnd.validationMetrics))),
            ("random_range", len(drawn.validationMetrics), float(min(drawn.validationMetrics)))]
    return spark.createDataFrame(rows, "kind string, n_candidates int, best_rmse double")


# ---------------------------------------------------------------- K: clustering

@query("k1_kmeans_lloyd", """
WITH p AS (SELECT l_quantity AS x, l_discount * 100 AS y FROM lineitem),
a1 AS (SELECT x, y, CASE WHEN (x - 10) * (x - 10) + (y - 2) * (y - 2) <= (x - 40) * (x - 40) + (y - 8) * (y - 8) THEN 0 ELSE 1 END AS c FROM p),
c1 AS (SELECT c, avg(x) AS cx, avg(y) AS cy FROM a1 GROUP BY c),
a2 AS (SELECT x, y, CASE WHEN (x - (SELECT cx FROM c1 WHERE c = 0)) * (x - (SELECT cx FROM c1 WHERE c = 0)) + (y - (SELECT cy FROM c1 WHERE c = 0)) * (y - (SELECT cy FROM c1 WHERE c = 0))
                          <= (x - (SELECT cx FROM c1 WHERE c = 1)) * (x - (SELECT cx FROM c1 WHERE c = 1)) + (y - (SELECT cy FROM c1 WHERE c = 1)) * (y - (SELECT cy FROM c1 WHERE c = 1))
                     THEN 0 ELSE 1 END AS c FROM p)
SELECT c AS cluster, round(avg(x), 6) AS cx, round(avg(y), 6) AS cy FROM a2 GROUP BY c
""")
def k1_kmeans_lloyd(spark, sf_dir):
    li = Tables(spark, sf_dir).lineitem.select(F.array("l_quantity", F.col("l_discount") * 100).alias("p"))
    cents = K.kmeans_lloyd(li, "p", [[10.0, 2.0], [40.0, 8.0]], iters=2)
    return spark.createDataFrame([(i, round(c[0], 6), round(c[1], 6)) for i, c in enumerate(cents)],
                                 "cluster int, cx double, cy double")


@query("k2_kmeans")
def k2_kmeans(spark, sf_dir):
    e = Tables(spark, sf_dir).embeddings
    m = K.kmeans(e, "embedding", 10)
    from pyspark.ml.functions import array_to_vector
    return m.transform(e.withColumn("__f", array_to_vector(F.col("embedding").cast("array<double>")))).groupBy(
        "prediction").agg(F.count(F.lit(1)).alias("n"))


@query("k3_seeded_kmeans")
def k3_seeded_kmeans(spark, sf_dir):
    e = Tables(spark, sf_dir).embeddings
    lab = e.withColumn("seed_label", F.when(S.hash_key("vec_id", "seed") < "33333333", F.col("label")))
    _, assigned = K.seeded_kmeans(lab, "embedding", "seed_label", iters=5)
    return assigned.select("vec_id", "label", "cluster_label")


@query("k4_spread", """
WITH d AS (SELECT label, i, x FROM (SELECT label, embedding AS e FROM embeddings), range(1, 65) r(i), LATERAL (SELECT e[i] AS x)),
per AS (SELECT label, i, sum(x * x) - sum(x) * sum(x) / count(*) AS sse_j FROM d GROUP BY label, i),
c AS (SELECT label, sum(sse_j) AS sse FROM per GROUP BY label)
SELECT round(sum(sse), 4) AS sse, round(sum(sqrt(greatest(sse, 0))), 6) AS sum_sqrt_sse FROM c
""")
def k4_spread(spark, sf_dir):
    r = K.spread(Tables(spark, sf_dir).embeddings, "embedding", "label")
    return r.select(F.round("sse", 4).alias("sse"), F.round("sum_sqrt_sse", 6).alias("sum_sqrt_sse"))


@query("k4_elbow")
def k4_elbow(spark, sf_dir):
    return K.elbow(Tables(spark, sf_dir).embeddings, "embedding", [2, 4, 8])


@query("k5_silhouette", """
WITH d AS (SELECT a.vec_id, a.label AS ca, b.label AS cb, a.vec_id = b.vec_id AS self,
                  list_sum(list_transform(list_zip(a.embedding, b.embedding), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS d2
           FROM embeddings a, embeddings b),
m AS (SELECT vec_id, ca, cb, sum(d2) AS s, count(*) AS n FROM d GROUP BY ALL),
ab AS (SELECT vec_id, ca, max(CASE WHEN ca = cb THEN s / (n - 1) END) AS a, max(CASE WHEN ca = cb THEN n END) AS own,
              min(CASE WHEN ca <> cb THEN s / n END) AS b FROM m GROUP BY vec_id, ca)
SELECT round(avg(CASE WHEN own <= 1 THEN 0 ELSE (b - a) / greatest(a, b) END), 6) AS silhouette FROM ab
""")
def k5_silhouette(spark, sf_dir):
    e = Tables(spark, sf_dir).embeddings
    s = K.silhouette(e, "embedding", "label", "vec_id")
    return s.agg(F.round(F.avg("silhouette"), 6).alias("silhouette"))


@query("k6_ari_nmi", """
WITH ct AS (SELECT l_returnflag AS a, l_linestatus AS b, count(*) AS n FROM lineitem GROUP BY ALL),
ra AS (SELECT a, sum(n) AS n FROM ct GROUP BY a), rb AS (SELECT b, sum(n) AS n FROM ct GROUP BY b),
t AS (SELECT (SELECT sum(n) FROM ct) AS n),
s AS (SELECT (SELECT sum(n * (n - 1) / 2.0) FROM ct) AS sct, (SELECT sum(n * (n - 1) / 2.0) FROM ra) AS sa,
             (SELECT sum(n * (n - 1) / 2.0) FROM rb) AS sb, (SELECT n FROM t) AS n),
h AS (SELECT -(SELECT sum(n / (SELECT n FROM t) * ln(n / (SELECT n FROM t))) FROM ra) AS ha,
             -(SELECT sum(n / (SELECT n FROM t) * ln(n / (SELECT n FROM t))) FROM rb) AS hb,
             (SELECT sum(ct.n / t.n * ln(ct.n * t.n / (ra.n * rb.n))) FROM ct JOIN ra USING (a) JOIN rb USING (b), t) AS mi)
SELECT round((sct - sa * sb / (n * (n - 1) / 2.0)) / (0.5 * (sa + sb) - sa * sb / (n * (n - 1) / 2.0)), 9) AS ari,
       round(mi / ((ha + hb) / 2), 9) AS nmi FROM s, h
""")
def k6_ari_nmi(spark, sf_dir):
    r = K.ari_nmi(Tables(spark, sf_dir).lineitem, "l_returnflag", "l_linestatus")
    return r.select(F.round("ari", 9).alias("ari"), F.round("nmi", 9).alias("nmi"))


# ---------------------------------------------------------------- vectors

def _emb(spark, sf_dir):
    return Tables(spark, sf_dir).embeddings.select(F.col("vec_id"), F.col("embedding").alias("vec"), "label")


@query("t17_phrase_vectors")
def t17_phrase_vectors(spark, sf_dir):
    """Benchmark texts as the mean vector of their known words (word i of the frequency-ranked
    document vocabulary owns embedding row i)."""
    t = Tables(spark, sf_dir)
    from tessera.operators import aggregate as A
    n_vec = t.embeddings.count()
    toks = t.documents.select(F.explode(FT.wordpunct_tokens("text")).alias("token"))
    top = A.vocab_topk(A.token_counts(toks), n_vec)
    ranked = S.global_row_number(top, [F.desc("n"), "token"], "rk")
    emb = ranked.join(t.embeddings.select((F.col("vec_id") + 1).alias("rk"), F.col("embedding").alias("vec")), "rk") \
        .select(F.col("token").alias("word"), "vec")
    docs = t.benchmark.select(F.col("item_id").alias("doc_id"), FT.wordpunct_tokens("text").alias("tokens"))
    pv = V.phrase_vectors(docs, emb, dim=64)
    return pv.select("doc_id", F.aggregate("vec", F.lit(0.0), lambda a, x: a + x).alias("vec_sum"))


@query("t18_nearest", """
WITH s AS (SELECT a.vec_id AS qid, b.vec_id AS cid, list_cosine_similarity(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])) AS score
           FROM embeddings a, embeddings b WHERE a.vec_id <> b.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY score DESC, cid) AS rank FROM s)
SELECT qid, cid, round(score, 6) AS score, rank FROM r WHERE rank <= 5
""")
def t18_nearest(spark, sf_dir):
    e = _emb(spark, sf_dir)
    nn = V.nearest(e.select(F.col("vec_id").alias("qid"), "vec"), e.select(F.col("vec_id").alias("cid"), "vec"), 5,
                   "cosine", exclude_self=True)
    return nn.select("qid", "cid", F.round("score", 6).alias("score"), "rank")


@query("t18_nearest_blocked", """
WITH s AS (SELECT a.vec_id AS qid, b.vec_id AS cid, list_cosine_similarity(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])) AS score
           FROM embeddings a, embeddings b WHERE a.vec_id <> b.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY score DESC, cid) AS rank FROM s)
SELECT qid, cid, round(score, 6) AS score, rank FROM r WHERE rank <= 5
""")
def t18_nearest_blocked(spark, sf_dir):
    """The same search over many small cells and blocks."""
    e = _emb(spark, sf_dir)
    nn = V.nearest(e.select(F.col("vec_id").alias("qid"), "vec"), e.select(F.col("vec_id").alias("cid"), "vec"), 5,
                   "cosine", exclude_self=True, block_rows=128)
    return nn.select("qid", "cid", F.round("score", 6).alias("score"), "rank")


@query("t19_ann_search")
def t19_ann_search(spark, sf_dir):
    """Five neighbours of every embedding from the inverted file (recall against T18: tests and README)."""
    e = _emb(spark, sf_dir)
    found = V.ann_search(e.select(F.col("vec_id").alias("qid"), "vec"), e.select(F.col("vec_id").alias("cid"), "vec"), 5, exclude_self=True)
    return found.select("qid", "cid", "rank", F.round("score", 6).alias("score"))


@query("t20_fit_alignment")
def t20_fit_alignment(spark, sf_dir):
    """Least-squares and orthogonal maps from each embedding to its reversed copy; W^T W = I is checked."""
    e = Tables(spark, sf_dir).embeddings.select(F.col("embedding").cast("array<double>").alias("x"),
                                                F.reverse(F.col("embedding").cast("array<double>")).alias("y"))
    w_ls = V.fit_alignment(e, orthogonal=False)
    w_or = V.fit_alignment(e, orthogonal=True)
    return spark.createDataFrame([
        ("least_squares", float(np.abs(w_ls - np.eye(64)[::-1]).max()), float(np.abs(w_ls.T @ w_ls - np.eye(64)).max())),
        ("orthogonal", float(np.abs(w_or - np.eye(64)[::-1]).max()), float(np.abs(w_or.T @ w_or - np.eye(64)).max()))],
        "method string, max_abs_err_vs_reversal double, max_abs_err_orthonormal double")


@query("t21_precision_at_k")
def t21_precision_at_k(spark, sf_dir):
    """Queries = embeddings mapped by the orthogonal map fitted on (x, reversed x); truth = reversed self."""
    base = Tables(spark, sf_dir).embeddings.select("vec_id", F.col("embedding").cast("array<double>").alias("vec"))
    pairs = base.select(F.col("vec").alias("x"), F.reverse("vec").alias("y"))
    w = V.fit_alignment(pairs, orthogonal=True)
    mapped = V.apply_map(base, w, "vec", "m").select(F.col("vec_id").alias("qid"), F.col("m").alias("vec"))
    target = base.select(F.col("vec_id").alias("cid"), F.reverse("vec").alias("vec"))
    nn = V.nearest(mapped, target, 5)
    truth = base.select(F.col("vec_id").alias("qid"), F.col("vec_id").alias("cid"))
    return V.precision_at_k(nn, truth, (1, 5))


@query("t21_translate_tokens")
def t21_translate_tokens(spark, sf_dir):
    """Benchmark texts translated word by word: word i of the frequency-ranked document vocabulary owns embedding row i,
    the target language has the same words reversed and mirrored vectors, the map is fitted on the pairs."""
    from tessera.operators import aggregate as A

    t = Tables(spark, sf_dir)
    base = t.embeddings.select("vec_id", F.col("embedding").cast("array<double>").alias("vec"))
    toks = t.documents.select(F.explode(FT.wordpunct_tokens("text")).alias("token"))
    top = A.vocab_topk(A.token_counts(toks), base.count())
    ranked = S.global_row_number(top, [F.desc("n"), "token"], "rk").select((F.col("rk") - 1).alias("vec_id"), F.col("token").alias("word"))
    src = ranked.join(base, "vec_id").select("word", "vec")
    dst = src.select(F.reverse("word").alias("word"), F.reverse("vec").alias("vec"))
    w = V.fit_alignment(base.select(F.col("vec").alias("x"), F.reverse("vec").alias("y")), orthogonal=True)
    docs = t.benchmark.select(F.col("item_id").alias("doc_id"), FT.wordpunct_tokens("text").alias("tokens"))
    return V.translate_tokens(docs, src, dst, w)


# ---------------------------------------------------------------- Q: sampling

@query("q1_split_exact", """
WITH r AS (SELECT o_orderkey, row_number() OVER (ORDER BY substr(md5(CAST(o_orderkey AS VARCHAR) || '42'), 1, 8), o_orderkey) AS rn,
                  count(*) OVER () AS n FROM orders)
SELECT o_orderkey, CASE WHEN rn <= CAST(floor(0.7 * n) AS BIGINT) THEN 'train'
                        WHEN rn <= CAST(floor(0.9 * n) AS BIGINT) THEN 'valid' ELSE 'test' END AS split FROM r
""")
def q1_split_exact(spark, sf_dir):
    o = Tables(spark, sf_dir).orders.select("o_orderkey")
    return S.split_exact(o, "o_orderkey", (0.7, 0.2, 0.1), "42")


@query("q2_split_hash", """
SELECT o_orderkey, substr(md5(CAST(o_orderkey AS VARCHAR) || '7'), 1, 8) < '4ccccccc' AS is_test FROM orders
""")
def q2_split_hash(spark, sf_dir):
    o = Tables(spark, sf_dir).orders.select("o_orderkey")
    test, train = S.split_hash(o, "o_orderkey", 0.3, "7")
    return test.withColumn("is_test", F.lit(True)).unionByName(train.withColumn("is_test", F.lit(False)))


@query("q3_split_ordered", """
WITH r AS (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS rn, count(*) OVER () AS n FROM orders)
SELECT o_orderkey, CASE WHEN rn <= CAST(floor(n * 0.6) AS BIGINT) THEN 'train'
                        WHEN rn <= CAST(floor(n * (0.6 + 0.2)) AS BIGINT) THEN 'valid' ELSE 'test' END AS split FROM r
""")
def q3_split_ordered(spark, sf_dir):
    o = Tables(spark, sf_dir).orders.select("o_orderkey", "o_orderdate")
    return S.split_ordered(o, ["o_orderdate"], "o_orderkey", 0.6, 0.2).select("o_orderkey", "split")


@query("q4_node_masks", """
SELECT o_orderkey, CAST(o_orderstatus <> 'F' AND o_orderpriority <> '1-URGENT' AS INTEGER) AS train_mask,
       CAST(o_orderstatus = 'F' AS INTEGER) AS valid_mask, CAST(o_orderpriority = '1-URGENT' AS INTEGER) AS test_mask FROM orders
""")
def q4_node_masks(spark, sf_dir):
    o = Tables(spark, sf_dir).orders
    r = S.node_masks(o.select("o_orderkey"), "o_orderkey", o.where(F.col("o_orderstatus") == "F"),
                     o.where(F.col("o_orderpriority") == "1-URGENT"))
    return r.select("o_orderkey", "train_mask", "valid_mask", "test_mask")


@query("q4_node_masks_extra")
def q4_node_masks_extra(spark, sf_dir):
    o = Tables(spark, sf_dir).orders
    r = S.node_masks(o.select("o_orderkey"), "o_orderkey", o.where(F.col("o_orderstatus") == "F"),
                     o.where(F.col("o_orderpriority") == "1-URGENT"), extra_rate=0.1, seed="x")
    return r.groupBy("train_mask", "valid_mask", "test_mask").agg(F.count(F.lit(1)).alias("n"))


@query("q5_split_semi", """
WITH r AS (SELECT doc_id, row_number() OVER (ORDER BY substr(md5(CAST(doc_id AS VARCHAR) || '42'), 1, 8), doc_id) AS rn,
                  count(*) OVER () AS n FROM documents)
SELECT doc_id, CASE WHEN rn <= CAST(floor(5 / 100.0 * n) AS BIGINT) THEN 'labelled'
                    WHEN rn <= CAST(floor(5 / 100.0 * n) AS BIGINT) + CAST(floor(3 / 100.0 * n) AS BIGINT) THEN 'validation'
                    ELSE 'unlabelled' END AS split FROM r
""")
def q5_split_semi(spark, sf_dir):
    d = Tables(spark, sf_dir).documents.select("doc_id")
    return S.split_semi(d, "doc_id", 5, 3, "42")


@query("q6_select_uncertain", """
SELECT user_id, round(avg(value / 100.0), 9) AS mean_conf FROM events GROUP BY user_id
HAVING abs(avg(value / 100.0) - 0.5) < 0.1 ORDER BY abs(avg(value / 100.0) - 0.5), user_id LIMIT 5
""")
def q6_select_uncertain(spark, sf_dir):
    e = Tables(spark, sf_dir).events.withColumn("conf", F.col("value") / 100.0)
    r = S.select_uncertain(e, "user_id", "conf", 0.5, 0.1, 5)
    return r.withColumn("mean_conf", F.round("mean_conf", 9))


@query("q7_select_by_entropy", """
SELECT user_id, round(-sum(value / 500.0 * ln(value / 500.0 + 1e-9)), 9) AS entropy FROM events GROUP BY user_id
ORDER BY -sum(value / 500.0 * ln(value / 500.0 + 1e-9)) DESC, user_id LIMIT 5
""")
def q7_select_by_entropy(spark, sf_dir):
    e = Tables(spark, sf_dir).events.withColumn("p", F.col("value") / 500.0)
    r = S.select_by_entropy(e, "user_id", "p", 5)
    return r.withColumn("entropy", F.round("entropy", 9))


@query("q8_select_by_variance", """
WITH v AS (SELECT user_id, event_type, var_samp(value / 500.0) AS v FROM events GROUP BY ALL)
SELECT user_id, round(avg(v), 9) AS variance FROM v GROUP BY user_id ORDER BY avg(v) DESC, user_id LIMIT 5
""")
def q8_select_by_variance(spark, sf_dir):
    e = Tables(spark, sf_dir).events.withColumn("p", F.col("value") / 500.0)
    r = S.select_by_variance(e, "user_id", ["event_type"], "p", 5)
    return r.withColumn("variance", F.round("variance", 9))


@query("q9_mixup")
def q9_mixup(spark, sf_dir):
    e = Tables(spark, sf_dir).embeddings.select("vec_id", F.col("embedding").cast("array<double>").alias("x"),
                                                F.col("label").cast("double").alias("y"))
    return S.mixup(e, "vec_id", "x", "y", alpha=0.4, seed=3).select("vec_id", "partner", "lam", "y")


@query("q9_cmixup_partners")
def q9_cmixup_partners(spark, sf_dir):
    li = Tables(spark, sf_dir).lineitem.withColumn("_k", F.concat_ws("|", "l_orderkey", "l_linenumber", "l_partkey"))
    return S.cmixup_partners(li.select("_k", "l_extendedprice"), "_k", "l_extendedprice", seed=5)


@query("q10_class_weights", "SELECT round((count(*) - sum(toxic)) / sum(toxic), 9) AS pos_weight FROM labels")
def q10_class_weights(spark, sf_dir):
    return S.class_weights(Tables(spark, sf_dir).labels, "toxic").select(F.round("pos_weight", 9).alias("pos_weight"))


@query("q10_rebalance")
def q10_rebalance(spark, sf_dir):
    lab = Tables(spark, sf_dir).labels
    under = S.rebalance(lab, "doc_id", "toxic", "under").groupBy("toxic").count().withColumn("mode", F.lit("under"))
    over = S.rebalance(lab, "doc_id", "toxic", "over").groupBy("toxic").count().withColumn("mode", F.lit("over"))
    return under.unionByName(over)
