"""Invariants from FIXTURES.md section 4, on the driver tables (sf0.001 / sf0.01)."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from table_dirs import SF_CHECK, SF_SMALL
from tessera.functions.text import wordpunct_tokens
from tessera.operators import features as G
from tessera.operators import metrics as M
from tessera.operators import sampling as S
from tessera.operators import text as T
from tessera.operators import tokenizer as TK
from tessera.operators import vectors as V
from tessera.session import Tables


@pytest.fixture(scope="module")
def docs(spark):
    return Tables(spark, SF_SMALL).documents.select("doc_id", wordpunct_tokens("text").alias("tokens"))


def test_mle_probs_sum_to_one(docs):
    p = T.ngram_probs(T.ngram_counts(docs, "tokens", 2))
    sums = p.groupBy("prefix").agg(F.sum("p").alias("s")).agg(F.min("s"), F.max("s")).first()
    assert sums[0] == pytest.approx(1.0) and sums[1] == pytest.approx(1.0)


def test_laplace_sums_to_one(docs):
    counts = T.ngram_counts(docs, "tokens", 2)
    V_ = counts.select("token").distinct().count()
    seen = T.laplace_probs(counts).groupBy("prefix").agg(F.sum("p").alias("s"), F.count(F.lit(1)).alias("k"))
    tot = seen.join(T.laplace_missing(counts), "prefix").select(
        (F.col("s") + F.col("p_missing") * (F.lit(V_) - F.col("k"))).alias("t"))
    r = tot.agg(F.min("t"), F.max("t")).first()
    assert r[0] == pytest.approx(1.0) and r[1] == pytest.approx(1.0)


def test_perplexity_order(spark, docs):
    c1, c3 = T.ngram_counts(docs, "tokens", 1), T.ngram_counts(docs, "tokens", 3)
    p1 = T.perplexity(c1, docs, "tokens", 1).first()["perplexity"]
    p3 = T.perplexity(c3, docs, "tokens", 3).first()["perplexity"]
    assert p1 > p3


def test_bpe_roundtrip_with_astral_chars(spark):
    df = spark.createDataFrame([(0, "hello world 🌎is here, naïve café 中文 ok"), (1, "low lower lowest 🌎🌎")],
                               "k long, text string")
    merges = TK.bpe_train(df, "text", 280, key="k")
    enc = TK.bpe_encode(df, "text", "k", merges)
    back = enc.select("k", TK.bpe_decode("ids", merges, spark).alias("t")).join(df, "k")
    assert back.where(F.col("t") != F.col("text")).count() == 0


def test_bpe_encode_moves_no_pretokens(spark):
    """Texts are encoded where they are read; those that share a key are put together by place, null and empty ones are empty."""
    rows = [(1, "low lower"), (2, None), (3, ""), (None, "slow low"), (5, "low  low\n\n é"), (6, "low a"), (6, "new b")]
    df = spark.createDataFrame(rows, "k long, text string")
    merges = [(108, 111, 256), (256, 119, 257), (32, 257, 258)]  # lo, low, " low"
    got = {r["k"]: list(r["ids"]) for r in TK.bpe_encode(df, "text", "k", merges).collect()}
    assert got == {1: [257, 258, 101, 114], 2: [], 3: [], None: [115, 257, 258], 5: [257, 32, 258, 10, 10, 32, 195, 169],
                   6: [110, 101, 119, 257, 32, 97, 32, 98]}
    once = df.where("k < 6").repartition(3)
    plan = TK.bpe_encode(once, "text", "k", merges)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.split("Union", 1)[1].split("Aggregate", 1)[0].count("Generate") == 0  # the first branch makes no rows of pre-tokens


def test_text_nb_probs(spark):
    t = Tables(spark, SF_SMALL)
    lab = t.documents.join(t.labels, "doc_id").select("doc_id", "toxic", wordpunct_tokens("text").alias("tokens"))
    from tessera.operators import aggregate as A
    vocab = A.vocab_topk(A.token_counts(lab.select(F.explode("tokens").alias("token"))), 500)
    b = T.bow(lab, "doc_id", "tokens", vocab)
    _, probs = T.text_nb_fit(b, lab, "doc_id", "toxic", vocab)
    r = probs.agg(F.sum("p0"), F.sum("p1"), F.min("p0"), F.min("p1")).first()
    assert r[0] == pytest.approx(1.0) and r[1] == pytest.approx(1.0) and r[2] > 0 and r[3] > 0


def test_alignment_orthonormal(spark):
    e = Tables(spark, SF_SMALL).embeddings.select(F.col("embedding").cast("array<double>").alias("x"))
    same = e.select("x", F.col("x").alias("y"))
    w = V.fit_alignment(same, orthogonal=True)
    assert np.abs(w.T @ w - np.eye(w.shape[0])).max() < 1e-8
    assert np.abs(w - np.eye(w.shape[0])).max() < 1e-6


def test_one_hot_rows(spark):
    o = Tables(spark, SF_SMALL).orders.select("o_orderkey", "o_orderpriority")
    o = o.withColumn("o_orderpriority", F.when(F.col("o_orderkey") < 5, None).otherwise(F.col("o_orderpriority")))
    oh = G.one_hot(o, ["o_orderpriority"])
    s = oh.select(sum(F.col(c) for c in oh.columns if c.startswith("o_orderpriority_")).alias("s"))
    assert {r[0] for r in s.distinct().collect()} <= {0, 1}


def test_splits_disjoint_exact_and_partition_invariant(spark):
    o = Tables(spark, SF_CHECK).orders.select("o_orderkey")
    n = o.count()
    a = S.split_exact(o, "o_orderkey", (0.7, 0.2, 0.1), "42")
    sizes = {r["split"]: r["count"] for r in a.groupBy("split").count().collect()}
    assert sizes["train"] == int(0.7 * n) and sizes["train"] + sizes["valid"] == int(0.9 * n)
    assert sum(sizes.values()) == n and a.select("o_orderkey").distinct().count() == n
    b = S.split_exact(o.repartition(1), "o_orderkey", (0.7, 0.2, 0.1), "42")
    assert a.exceptAll(b).count() == 0


def test_auc_curve_equals_rank(spark):
    t = Tables(spark, SF_CHECK)
    s = t.labels.join(t.documents.select("doc_id", "n_chars"), "doc_id").select(
        F.col("toxic").alias("y_true"), (F.col("n_chars") % 97).cast("double").alias("score"))
    a = M.auc_summary(s).first()["roc_auc"]
    b = M.auc_rank(s).first()["roc_auc"]
    assert a == pytest.approx(b)


def test_same_rows_with_one_and_many_partitions(spark):
    import __spark_entry__ as entry

    qs = entry.queries()
    names = ["relation_graph_hubs", "d3_rebuild_state", "w4_running_balance", "t1_ngram_counts", "o2_index_nodes"]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        res = {}
        for parts in ("1", "8"):
            spark.conf.set("spark.sql.shuffle.partitions", parts)
            res[parts] = {n: sorted(map(tuple, qs[n](spark, SF_SMALL).collect())) for n in names}
        assert res["1"] == res["8"]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_nearest_paths_agree(spark):
    e = Tables(spark, SF_SMALL).embeddings
    q = e.select(F.col("vec_id").alias("qid"), F.col("embedding").alias("vec"))
    c = e.select(F.col("vec_id").alias("cid"), F.col("embedding").alias("vec"))
    a = V.nearest(q, c, 3, exclude_self=True).select("qid", "cid", "rank")
    b = V.nearest(q, c, 3, exclude_self=True, block_rows=7).select("qid", "cid", "rank")
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_chunked_lag_lead_equal_plain(spark):
    from tessera.operators import ordered as W

    e = Tables(spark, SF_SMALL).events.select("event_id", "user_id", "ts", "value").withColumn("_d", F.to_date("ts"))
    for fn in (W.add_lag, W.add_lead):
        a = fn(e, "user_id", ["ts", "event_id"], "value", "o").select("event_id", "o")
        b = fn(e, "user_id", ["ts", "event_id"], "value", "o", chunk="_d").select("event_id", "o")
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
