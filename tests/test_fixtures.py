"""The reference's own constants (FIXTURES.md section 3) as small in-memory checks."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.functions.rewards import equation_reward, format_reward
from tessera.functions.units import to_litres
from tessera.operators import cluster as K
from tessera.operators import clean as C
from tessera.operators import graph as G
from tessera.operators import metrics as M
from tessera.operators import models as MD
from tessera.operators import ordered as W
from tessera.operators import text as T
from tessera.operators import timeseries as H
from tessera.operators import tokenizer as TK


def test_classification_error_and_regression(spark):
    df = spark.createDataFrame([(1.0, 1.0), (2.0, 2.0), (3.0, 3.0), (4.0, 5.0)], "actual double, predicted double")
    assert M.loss_metrics(df).first()["classification_error"] == pytest.approx(0.25)
    df2 = spark.createDataFrame([(1.0, 1.0), (1.0, 1.0), (1.0, 1.0), (0.0, 1.0), (0.0, 0.0), (0.0, 0.0)],
                                "actual double, predicted double")
    assert M.loss_metrics(df2).first()["classification_error"] == pytest.approx(1 / 6)
    mae = M.regression_metrics(spark.createDataFrame([(1.0, 3.0), (2.0, 2.0), (3.0, 1.0)], "actual double, predicted double"))
    assert mae.first()["mae"] == pytest.approx(4 / 3)
    mse = M.regression_metrics(spark.createDataFrame([(1.0, 1.0), (2.0, 2.0), (3.0, 3.0), (4.0, 6.0)],
                                                     "actual double, predicted double"))
    assert mse.first()["mse"] == pytest.approx(1.0)
    rmse = M.regression_metrics(spark.createDataFrame([(1.0, 1.0), (2.0, 2.0), (3.0, 3.0), (4.0, 5.0)],
                                                      "actual double, predicted double"))
    assert rmse.first()["rmse"] == pytest.approx(0.5)
    e = math.e
    msle = M.regression_metrics(spark.createDataFrame([(1.0, 1.0), (2.0, 2.0), (3.0, 3.0), (e - 1, e * e - 1)],
                                                      "actual double, predicted double")).first()
    assert msle["msle"] == pytest.approx(0.25) and msle["rmsle"] == pytest.approx(0.5)


def test_log_loss(spark):
    assert M.loss_metrics(spark.createDataFrame([(1.0, 1.0), (1.0, 1.0)], "actual double, predicted double")
                          ).first()["log_loss"] == pytest.approx(0.0, abs=1e-12)
    assert M.loss_metrics(spark.createDataFrame([(1.0, 0.5)], "actual double, predicted double")
                          ).first()["log_loss"] == pytest.approx(math.log(2))


def test_divergences(spark):
    p = spark.createDataFrame([(0, 0.4), (1, 0.6)], "k int, prob double")
    q = spark.createDataFrame([(0, 0.35), (1, 0.65)], "k int, prob double")
    r = M.divergence(p, q).first()
    assert r["kl"] == pytest.approx(0.0053869324, abs=1e-9)
    assert r["js"] == pytest.approx(0.0013340851, abs=1e-9)
    assert r["hellinger"] == pytest.approx(0.0365302817, abs=1e-9)


def test_rate_estimates(spark):
    data = [1, 0, 1, 1, 0, 1, 1, 1, 0, 0]
    df = spark.createDataFrame([(0, x) for x in data], "g int, y int")
    r = M.rate_estimates(df, "g", "y", 6, 4).first()
    assert r["mle"] == pytest.approx(0.6) and r["map"] == pytest.approx(0.6)


def test_kmeans_lloyd_fixture(spark):
    pts = [(1, 2), (1, 4), (1, 0), (10, 2), (10, 4), (10, 0)]
    df = spark.createDataFrame([([float(a), float(b)],) for a, b in pts], "p array<double>")
    cents = K.kmeans_lloyd(df, "p", [[1.0, 1.0], [10.0, 1.0]], iters=10)
    assert cents == [[1.0, 2.0], [10.0, 2.0]]


def test_ridge_fixture(spark):
    xs, ys = [1, 3, 5, 7, 9, 10], [3, 7, 11, 15, 19, 23]
    df = spark.createDataFrame(list(zip(map(float, xs), map(float, ys))), "x double, y double")
    r = MD.ridge_fit(df, ["x"], "y", 1.0)
    assert r["coef"]["x"] == pytest.approx(2.1024258760, abs=1e-9)
    assert r["intercept"] == pytest.approx(0.7358490566, abs=1e-9)


def test_mse_gradient_fixture(spark):
    df = spark.createDataFrame([(1.0, 1.0, 1.0), (1.0, 2.0, 2.0), (1.0, 3.0, 3.0)], "a double, b double, y double")
    g = MD.mse_gradient(df, ["a", "b"], "y", [0.0, 0.0])
    assert g == pytest.approx([-4.0, -9.3333333], abs=1e-6)


def test_neighbor_mean_fixture(spark):
    adj = [[1, 1, 0, 0], [1, 1, 1, 1], [0, 1, 1, 1], [0, 1, 1, 1]]
    # adj[i][j] = 1: node i aggregates node j (self loops included)
    edges = spark.createDataFrame([(j, i) for i in range(4) for j in range(4) if adj[i][j]], "src int, dst int")
    feats = spark.createDataFrame([(i, [float(2 * i), float(2 * i + 1)]) for i in range(4)], "node int, features array<double>")
    out = {r["node"]: r["features"] for r in G.neighbor_mean(edges, feats).collect()}
    assert out == {0: [1.0, 2.0], 1: [3.0, 4.0], 2: [4.0, 5.0], 3: [4.0, 5.0]}


def test_kalman_scalar_fixture(spark):
    radar, camera = [49, 51, 50.5, 51], [50.5, 50, 49.5, 50]
    rows = []
    for i, (r, c) in enumerate(zip(radar, camera)):
        rows += [(1, 2 * i, float(r), 4.0), (1, 2 * i + 1, float(c), 1.0)]
    df = spark.createDataFrame(rows, "k int, t int, z double, r double")
    out = H.kalman_scalar(df, "k", "t", "z", "r", 50.0, 10.0).orderBy("t").collect()
    after_pairs = [out[i]["x"] for i in (1, 3, 5, 7)]
    assert after_pairs == pytest.approx([50.185185, 50.192308, 50.032468, 50.073529], abs=1e-6)
    assert out[-1]["P"] == pytest.approx(0.196078, abs=1e-6)


def test_kalman_cv_fixture(spark):
    df = spark.createDataFrame([(1, 0, 10.0, 0.2), (1, 1, 9.5, 0.1)], "k int, t int, z double, r double")
    out = H.kalman_cv(df, "k", ["t"], "z", "r", q=0.1).orderBy("t").collect()[-1]
    assert out["position"] == pytest.approx(9.8256227758, abs=1e-9)
    assert out["velocity"] == pytest.approx(1.8985765125, abs=1e-9)


def test_histogram_filter_fixture(spark):
    world = ["empty", "wall", "empty", "door", "empty"]
    df = spark.createDataFrame([(1, 0, "wall")], "k int, t int, m string")
    b = H.histogram_filter(df, "k", ["t"], "m", world).first()["belief"]
    assert b == pytest.approx([0.142857, 0.2, 0.371429, 0.142857, 0.142857], abs=1e-6)


def test_discounted_returns_fixture(spark):
    df = spark.createDataFrame([(1, 0, 1.0), (1, 1, 2.0), (1, 2, 3.0)], "tr int, t int, r double")
    for block in (256, 2):
        out = [r["G"] for r in W.discounted_returns(df, "tr", "t", "r", 0.9, block=block).orderBy("t").collect()]
        assert out == pytest.approx([5.23, 4.7, 3.0])
    with pytest.raises(ValueError):
        W.discounted_returns(df, "tr", "t", "r", 0.9, block=1)


def test_bpe_merges_fixture(spark):
    df = spark.createDataFrame([(0, "low low low low low lower lower widest widest widest newest newest newest "
                                     "newest newest newest")], "k long, text string")
    merges = TK.bpe_train(df, "text", 262, key="k")
    vocab = TK.vocab_bytes(merges)
    assert [vocab[n] for _, _, n in merges] == [b"st", b"est", b"ow", b"low", b"west", b"ne"]


def test_rewards_fixture(spark):
    c1 = ("We need to find an equation using the numbers 19, 36, 55, and 7\nexactly once, with basic arithmetic "
          "operations, that equals 65. One possible\ncombination is 55 + 36 - 19 + 7... </think>\n"
          "<answer> 55 + 36 - 7 - 19 </answer>")
    c2 = " ... </think>\n<answer> 55 + 36 - 7 - 19 </answer>"
    c3 = "User: Using the numbers [19, 36, 55, 7], create an equation that equals 65."
    c4 = ("To find the equation that equals 79 using the numbers 95, 78, 6, 88, I'll start by adding 88 and 95:\n"
          "95 + 88 = 183\nNow, let's subtract 104 from 183 to get 79:\n183 - 104 = 79\n"
          "<think> 183 - 104 = 79 </think><think> 183 - 104 = 79 </think><answer> 183 - 104 = 79 </answer>")
    c5 = " ... </think>\n<answer> 55 + 36 - 7 - 18 </answer>"
    df = spark.createDataFrame([(i, c, "65", [19, 36, 55, 7]) for i, c in enumerate([c1, c2, c3, c4, c5])],
                               "i int, c string, target string, nums array<int>")
    out = df.select("i", format_reward("c").alias("f"), equation_reward("c", "target", "nums").alias("e")).orderBy("i")
    rows = out.collect()
    assert [r["f"] for r in rows] == [1.0, 1.0, 0.0, 0.0, 1.0]
    assert [r["e"] for r in rows] == [1.0, 1.0, 0.0, 0.0, 0.0]


def test_ngram_prefix_padding(spark):
    df = spark.createDataFrame([(["the", "new", "approach"],)], "tokens array<string>")
    ev = [(r["prefix"], r["token"]) for r in T.ngram_events(df, "tokens", 3).collect()]
    assert ev == [("_UNK_ _UNK_", "the"), ("_UNK_ the", "new"), ("the new", "approach"), ("new approach", "_EOS_")]


def test_to_litres(spark):
    df = spark.createDataFrame([("500ml",), ("1.5lt",), (None,)], "c string")
    assert [r[0] for r in df.select(to_litres("c")).collect()] == [0.5, 1.5, None]
    with pytest.raises(Exception):
        spark.createDataFrame([("3kg",)], "c string").select(to_litres("c")).collect()
    assert spark.createDataFrame([("3kg",)], "c string").select(to_litres("c", strict=False)).first()[0] is None


def test_simplify_category(spark):
    df = spark.createDataFrame([("bag, wallet",), ("shirt, blouse",)], "c string")
    assert [r[0] for r in df.select(C.simplify_category("c")).collect()] == ["bag", "shirt"]


def test_silhouette_matches_bruteforce(spark):
    rng = np.random.default_rng(0)
    pts = np.concatenate([rng.normal(0, 1, (20, 3)), rng.normal(4, 1, (15, 3)), rng.normal(-4, 1, (10, 3))])
    lab = [0] * 20 + [1] * 15 + [2] * 10
    df = spark.createDataFrame([(i, p.tolist(), l) for i, (p, l) in enumerate(zip(pts, lab))], "id int, v array<double>, c int")
    got = {r["id"]: r["silhouette"] for r in K.silhouette(df, "v", "c", "id").collect()}
    d2 = ((pts[:, None, :] - pts[None, :, :]) ** 2).sum(-1)
    lab = np.array(lab)
    for i in range(len(pts)):
        own = lab == lab[i]
        a = d2[i, own].sum() / (own.sum() - 1)
        b = min(d2[i, lab == c].mean() for c in set(lab) if c != lab[i])
        assert got[i] == pytest.approx((b - a) / max(a, b), abs=1e-9)
