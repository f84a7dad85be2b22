"""Cases that ordinary tables do not contain: nulls, ties, constants, empty classes, long sequences."""

import io
import json
import os
import random
import zipfile
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tessera.functions import rewards as RW
from tessera.functions import vectors as FV
from tessera.operators import features as FE
from tessera.operators import joins as J
from tessera.operators import metrics as M
from tessera.operators import models as MO
from tessera.operators import ordered as W
from tessera.operators import sampling as S
from tessera.operators import text as T
from tessera.operators import tokenizer as TK
from tessera.operators import vectors as V
from tessera.sources import files as IO


@pytest.fixture(scope="module")
def series(spark):
    """Keys (one null) in two chunks, with nulls inside."""
    rows = [(k, c, 2 * c + i, v) for k in ("a", None) for c, part in enumerate(([9, 1], [None, 5])) for i, v in enumerate(part)]
    return spark.createDataFrame(rows, "k string, c int, t int, v int").cache()


def _by_time(df, col):
    return {k: [r[col] for r in sorted(rows, key=lambda r: r.t)] for k, rows in _groups(df).items()}


def _groups(df):
    out = {}
    for r in df.collect():
        out.setdefault(r.k, []).append(r)
    return out


def test_chunked_lag_wraps_the_first_row_only(series):
    plain = _by_time(W.add_lag(series, "k", "t", "v", "p", wrap=True), "p")
    chunked = _by_time(W.add_lag(series, "k", "t", "v", "p", wrap=True, chunk="c"), "p")
    assert plain == chunked == {k: [5, 9, 1, None] for k in ("a", None)}


def test_chunked_carries_reach_null_keys(series):
    s = series.fillna(0, "v")
    assert _by_time(W.cumulative_sum(s, "k", "t", ["v"], chunk="c"), "v_cum") == {k: [9, 10, 10, 15] for k in ("a", None)}
    assert _by_time(W.add_lead(s, "k", "t", "v", "n", chunk="c"), "n") == {k: [1, 0, 5, None] for k in ("a", None)}


def test_chunked_interpolation_equals_plain(spark):
    rng = random.Random(6)
    rows = [(rng.choice(["a", "b", None]), t // 9, t, rng.choice([None, 0.0, float(rng.randint(1, 50))])) for t in range(200)]
    df = spark.createDataFrame(rows, "k string, c int, t int, v double")
    for missing in (True, False):
        plain = {(r.k, r.t): r.v for r in W.interpolate_linear(df, "k", "t", "v", zero_is_missing=missing).collect()}
        chunked = {(r.k, r.t): r.v for r in W.interpolate_linear(df, "k", "t", "v", zero_is_missing=missing, chunk="c").collect()}
        assert plain == chunked and any(v is not None for v in plain.values())


@pytest.mark.parametrize("n", [1, 3, 25])
def test_chunked_moving_average_equals_plain(spark, n):
    rng = random.Random(n)
    rows = [(k, t // 4 + (t > 60) * 5, t, float(rng.randint(0, 9))) for k in ("a", None) for t in range(90)]
    df = spark.createDataFrame(rows, "k string, c int, t int, v double")
    plain = {(r.k, r.t): (r.m, r[f"v_std{n}"]) for r in W.moving_average(df, "k", "t", "v", n, "m", with_std=True).collect()}
    cut = W.moving_average(df, "k", "t", "v", n, "m", with_std=True, chunk="c")
    assert cut.columns == ["k", "c", "t", "v", "m", f"v_std{n}"]
    got = {(r.k, r.t): (r.m, r[f"v_std{n}"]) for r in cut.collect()}
    assert got.keys() == plain.keys()
    for at, want in plain.items():
        assert got[at] == pytest.approx(want)


def test_drop_first_per_key(spark):
    df = spark.createDataFrame([(k, t) for k in ("a", None) for t in range(5)] + [("b", 1)], "k string, t int")
    assert sorted((r.k or "", r.t) for r in W.drop_first(df, "k", "t", 2).collect()) == [("", 2), ("", 3), ("", 4), ("a", 2), ("a", 3), ("a", 4)]


def test_orders_consume_stock(spark):
    rng = random.Random(4)
    stock = {i: float(rng.randint(5, 60)) for i in range(12)}
    lines = [(o, rng.choice(list(stock) + [99] * (o % 17 == 0)), None if o % 29 == 0 else float(rng.randint(0 if o % 13 == 0 else 1, 12)))
             for o in range(150) for _ in range(rng.randint(1, 4))]
    left, want = dict(stock), {}
    for o in range(150):
        mine = [(i, q) for x, i, q in lines if x == o]
        asked = {}
        for i, q in mine:
            asked[i] = asked.get(i, 0) + (q or 0)
        if any(q is None or q <= 0 for _, q in mine):
            want[o] = "invalid_request"
        elif any(i not in stock for i, _ in mine):
            want[o] = "no_match"
        elif any(q > left[i] for i, q in asked.items()):
            want[o] = "insufficient_stock"
        else:
            want[o] = "success"
            for i, q in asked.items():
                left[i] -= q
    ldf = spark.createDataFrame(lines, "order_id int, item_id int, qty double")
    sdf = spark.createDataFrame(list(stock.items()), "item_id int, quantity_in_stock double")
    got = W.apply_orders(ldf, sdf)
    assert {r.order_id: r.status for r in got.collect()} == want
    after = {r.item_id: r.quantity_in_stock for r in W.stock_after(ldf, sdf, got).collect()}
    assert after == left and min(after.values()) >= 0


def test_constant_series_give_null(spark):
    s = spark.createDataFrame([("a", i, 3.0, 3.0) for i in range(3)] + [("b", 0, 1.0, 2.0)], "k string, t int, v double, p double")
    z = W.rolling_stats(s.withColumn("ts", F.timestamp_seconds("t")), "k", "ts", "v").select("z").collect()
    assert all(r.z is None for r in z)
    assert {r.acf for r in W.acf(s, "k", "t", "v", [1]).collect()} == {None}
    metrics = {(r.k, r.metric): r.value for r in M.forecast_metrics(s, "k", "t", "v", "p").collect()}
    assert metrics["a", "mase"] is None and metrics["b", "std_ae"] is None and metrics["b", "mae"] == 1.0
    assert [r.v for r in FE.standardize(s, ["v"]).where("k = 'a'").limit(1).collect()][0] is not None
    one = s.where("k = 'a'")
    assert {r.v for r in FE.standardize(one, ["v"]).collect()} == {None} == {r.v for r in FE.minmax(one, ["v"]).collect()}


@pytest.mark.parametrize("gamma", [0.95, 0.05])
def test_long_trajectories(spark, gamma):
    n = 5000
    df = spark.range(n).select(F.lit("a").alias("k"), F.col("id").alias("t"), (F.col("id") % 7).cast("double").alias("r"))
    got = {r.t: r.G for r in W.discounted_returns(df, "k", "t", "r", gamma).collect()}
    acc = 0.0
    for t in reversed(range(n)):
        acc = t % 7 + gamma * acc
        assert abs(got[t] - acc) < 1e-9


def test_gae_null_value_is_not_the_end(spark):
    df = spark.createDataFrame([("a", t, 0.0, 0.0, v, 1.0) for t, v in enumerate([1.0, None, 2.0])],
                               "k string, t int, l double, f double, v double, s double")
    got = {r.t: r.reward for r in W.gae(df, "k", "t", "l", "f", "v", "s").collect()}
    assert got == {0: 0.0, 1: 0.0, 2: 1.0}


def test_missing_class(spark):
    df = spark.createDataFrame([(0, 0.1), (0, 0.7)], "y_true int, score double")
    r = M.auc_summary(df).first()
    assert r.roc_auc is None and r.pr_auc is None
    assert S.class_weights(df, "y_true").first().pos_weight is None


def test_split_hash_takes_all_or_nothing(spark):
    df = spark.range(500)
    assert [x.count() for x in S.split_hash(df, "id", 1.0)] == [500, 0]
    assert [x.count() for x in S.split_hash(df, "id", 0.0)] == [0, 500]


def test_zero_vector(spark):
    df = spark.createDataFrame([([0.0, 0.0], [1.0, 2.0])], "a array<double>, b array<double>")
    assert df.select(FV.cosine_similarity("a", "b").alias("c")).first().c is None


def test_skipgram_keeps_texts_apart(spark):
    df = spark.createDataFrame([(["a", "x", "b"],), (["c"],), (["a", "b"],)], "tokens array<string>")
    vocab = spark.createDataFrame([("a",), ("b",), ("c",)], "token string")
    got = sorted((r.center, r.context) for r in T.skipgram_pairs(df, "tokens", 1, vocab).collect())
    assert got == [("a", "b"), ("a", "b"), ("b", "a"), ("b", "a")]


def test_nearest_breaks_ties_by_id(spark):
    rng = random.Random(2)
    corpus = [(i, [float(rng.randint(0, 1)), 1.0]) for i in rng.sample(range(300), 200)]
    c = spark.createDataFrame(corpus, "cid long, vec array<double>").repartition(4)
    q = spark.createDataFrame([(0, [1.0, 1.0]), (1, [0.0, 1.0])], "qid long, vec array<double>")
    got = {}
    for r in V.nearest(q, c, 5).collect():
        got.setdefault(r.qid, []).append((r["rank"], r.cid))
    for qid, x in ((0, 1.0), (1, 0.0)):
        assert [i for _, i in sorted(got[qid])] == sorted(i for i, v in corpus if v[0] == x)[:5]


def test_rewards_of_odd_answers(spark):
    body = "x</think>\n<answer> {} </answer>"
    rows = [(body.format("12345678901234567890 + 1"), "3", [1, 2]), (body.format("1 + 2"), "three", [1, 2]),
            (body.format("1 + 2"), "3", [1, 2]), (body.format("9" * 60), "1", [1])]
    df = spark.createDataFrame(rows, "c string, t string, n array<long>")
    assert [r.e for r in df.select(RW.equation_reward("c", "t", "n").alias("e")).collect()] == [0.0, 0.0, 1.0, 0.0]
    g = spark.createDataFrame([("p", 1.0), ("p", 0.0), ("q", 1.0)], "p string, r double")
    stats = sorted((r.p, r.r, r.reward_mean, round(r.reward_std, 6)) for r in RW.group_reward_stats(g, "p", "r").collect())
    assert stats == [("p", 0.0, 0.5, 0.707107), ("p", 1.0, 0.5, 0.707107), ("q", 1.0, 1.0, 0.0)]


def test_zipped_csv_keeps_quoted_line_ends(spark, tmp_path):
    text = 'a,b\n1,"two\nlines"\n2,sep arator\n'
    data = io.BytesIO()
    with zipfile.ZipFile(data, "w") as z:
        z.writestr("x.csv", text)
    (tmp_path / "x.zip").write_bytes(data.getvalue())
    got = sorted(tuple(r) for r in IO.read_zipped_csv(spark, str(tmp_path / "x.zip"), "a int, b string").collect())
    assert got == [(1, "two\nlines"), (2, "sep arator")]


def test_json_documents_are_named_by_their_place(spark, tmp_path):
    df = spark.range(5).repartition(2)
    for _ in range(2):  # a second writing replaces the first
        IO.write_json_documents(df, str(tmp_path / "d"))
    found = [json.loads((tmp_path / "d" / n).read_text())["id"] for n in os.listdir(tmp_path / "d")]
    assert sorted(found) == [0, 1, 2, 3, 4]


def test_zip_rows_follows_the_files(spark, tmp_path):
    for side, shift in (("l", 0), ("r", 100)):
        os.makedirs(tmp_path / side)
        for k, name in enumerate("cab"):
            (tmp_path / side / f"{name}.txt").write_text("".join(f"{shift + 10 * k + i}\n" for i in range(3)))
    a = spark.read.text(str(tmp_path / "l")).withColumnRenamed("value", "x")
    b = spark.read.text(str(tmp_path / "r")).withColumnRenamed("value", "y")
    got = [(int(r.x), int(r.y)) for r in J.zip_rows(a, b).orderBy("pos").collect()]
    assert [x for x, _ in got] == [10, 11, 12, 20, 21, 22, 0, 1, 2]  # files a, b, c
    assert all(y == x + 100 for x, y in got)


def test_score_batches_bounds_the_calls(spark):
    sizes = []
    got = MO.score_batches(spark.range(23).coalesce(1), lambda part: [len(part)] * len(part), batch_rows=5).collect()
    sizes = sorted({r.prediction for r in got})
    assert len(got) == 23 and max(sizes) <= 5


def test_one_hot_sparse(spark):
    df = spark.createDataFrame([(1, "x", "u"), (2, None, "v"), (3, "y", "u")], "i int, a string, b string")
    got = {r.i: r.onehot for r in FE.one_hot_sparse(df, ["a", "b"]).collect()}
    assert got == {1: [0, 2], 2: [3], 3: [1, 2]}


@pytest.mark.parametrize(("pretokenize", "tie"), [(True, "max_pair"), (False, "first_seen")])
def test_bpe_training_is_one_merge_at_a_time(spark, pretokenize, tie):
    import regex

    rng = random.Random(8)
    rows = [(i, " ".join("".join(rng.choice("abcd") for _ in range(rng.randint(1, 5))) for _ in range(12))) for i in range(12)]
    units = {}
    for k, t in rows:
        for pos, w in enumerate(regex.findall(TK.PRETOKEN_PATTERN, t) if pretokenize else [t]):
            units.setdefault(w if pretokenize else (k, w), [list(w.encode()), 0, (k, pos)])[1] += 1
    want = []
    for new in range(256, 270):
        count, seen = {}, {}
        for ids, n, first in units.values():
            for i, p in enumerate(zip(ids, ids[1:])):
                count[p] = count.get(p, 0) + n
                seen[p] = min(seen.get(p, (first, i)), (first, i))
        best = min(count, key=lambda p: (-count[p], seen[p])) if tie == "first_seen" else max(count, key=lambda p: (count[p], p))
        want.append((*best, new))
        for unit in units.values():
            unit[0] = TK.join_pieces(unit[0], {best: (0, new)})
    df = spark.createDataFrame(rows, "k long, t string")
    got = TK.bpe_train(df, "t", 270, key="k", pretokenize=pretokenize, tie=tie)
    assert [tuple(m) for m in got] == want


def test_join_pieces_equals_repeated_replacement():
    rng = random.Random(1)
    table = {(97, 97): (0, 256), (256, 98): (1, 257), (98, 99): (2, 258), (257, 258): (3, 259), (256, 256): (4, 260)}
    for _ in range(400):
        ids = [rng.choice(b"abc") for _ in range(rng.randint(0, 30))]
        want = list(ids)
        for pair, (_, new) in sorted(table.items(), key=lambda x: x[1]):
            out, i = [], 0
            while i < len(want):
                if tuple(want[i : i + 2]) == pair:
                    out.append(new)
                    i += 2
                else:
                    out.append(want[i])
                    i += 1
            want = out
        assert TK.join_pieces(ids, table) == want


@pytest.mark.parametrize("tie", ["max_pair", "first_seen"])
def test_bpe_training_by_bounded_choices(spark, tie):
    """Many turns over bounded choices of units give the merges of one turn over all of them."""
    rng = random.Random(8)
    words = ["the", "then", "aaaa", "banana", "é"] + ["".join(rng.choice("abcde") for _ in range(rng.randint(1, 9))) for _ in range(40)]
    df = spark.createDataFrame([(i, " ".join(rng.choice(words) for _ in range(rng.randint(0, 12)))) for i in range(50)], "k long, t string")
    whole = TK.bpe_train(df, "t", 400, key="k", tie=tie)
    assert len(whole) > 100
    assert TK.bpe_train(df, "t", 400, key="k", tie=tie, work=400) == whole
    assert TK.bpe_train(df, "t", 260, key="k", tie=tie, work=10, tracked=20) == whole[:4]  # by all tasks together


@pytest.mark.parametrize("pretokenize", [False, True])
@pytest.mark.parametrize("tie", ["max_pair", "first_seen"])
def test_bpe_training_cuts_long_units(spark, monkeypatch, tie, pretokenize):
    """Units of far more symbols than a task learns from are cut at rare pairs; no merge of all tasks is needed, and the merges are the same."""
    rng = random.Random(11)
    words = ["aaaa", "aaa", "banana", "é", "ab ab", ""] + ["".join(rng.choice("abcdef") for _ in range(rng.randint(1, 7))) for _ in range(30)]
    sep = "" if pretokenize else " "
    texts = [sep.join(rng.choice(words) for _ in range(rng.randint(0, 60))) for _ in range(40)] * 2 + [None, "", "x"]
    df = spark.createDataFrame(list(enumerate(texts)), "k long, t string")
    whole = TK.bpe_train(df, "t", 420, key="k", tie=tie, pretokenize=pretokenize)
    assert len(whole) == 164
    small = 1500
    together = TK.bpe_train(df, "t", 258, key="k", tie=tie, pretokenize=pretokenize, work=1)
    assert together == whole[:2]

    def barrier(*_):
        raise AssertionError("a merge of all tasks")

    monkeypatch.setattr(TK, "learn_together", barrier)
    assert TK.bpe_train(df, "t", 420, key="k", tie=tie, pretokenize=pretokenize, work=small) == whole


def test_bpe_training_sorts_texts_not_symbols(spark, monkeypatch):
    """Raw texts are numbered before they become symbols; the merges of many turns are those of one."""
    rng = random.Random(5)
    words = ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 8))) for _ in range(120)]
    df = spark.createDataFrame([(i, " ".join(rng.choice(words) for _ in range(60))) for i in range(60)], "k long, t string")
    whole = TK.bpe_train(df, "t", 556, key="k", pretokenize=False, tie="first_seen")
    numbered, turns = TK.global_row_number, []

    def number(rows, *args):
        assert not [c for c, kind in rows.dtypes if kind.startswith("array")]
        return numbered(rows, *args)

    def learn(*args):
        turns.append(args[1])
        return learn_alone(*args)

    learn_alone = TK.learn_alone
    monkeypatch.setattr(TK, "global_row_number", number)
    monkeypatch.setattr(TK, "learn_alone", learn)
    monkeypatch.setattr(TK, "WIDTH", 2)
    assert TK.bpe_train(df, "t", 556, key="k", pretokenize=False, tie="first_seen", work=6000) == whole
    assert len(whole) == 300 and turns == sorted(turns, reverse=True)


@pytest.mark.parametrize("name", ["t7_bpe_train_raw", "t8_bpe_train", "t25_prepare_parallel"])
def test_bpe_queries_train_in_full(spark, name):
    """The registered queries train on whole tables with the operator's default number of merges, as far as there are pairs."""
    from tessera import plans

    rows = plans.queries()[name](spark, "/root/testdata/sf0.001").collect()
    if name == "t25_prepare_parallel":
        assert all(0 < n <= 8000 for r in rows for n in (r.src_merges, r.dst_merges))
    else:
        assert [r.rank for r in sorted(rows)] == list(range(8256 - 256 - (name == "t8_bpe_train")))


def test_chunked_filters_equal_plain(spark):
    """H2-H4 by chunks give the rows of one pass over the key, null keys included."""
    from tessera.operators import timeseries as H

    rows = [(None if i % 3 == 2 else i % 3, i, i // 17, float(i * 7 % 11), 0.5 + i % 4, "xyz"[i * i % 3]) for i in range(120)]
    df = spark.createDataFrame(rows, "k int, t int, c int, z double, r double, m string")
    runs = [(lambda c: H.kalman_cv(df, "k", ["t"], "z", "r", chunk=c), ["k", "t"], ["position", "velocity", "P"]),
            (lambda c: H.kalman_fused(df, "k", ["t"], "z", "r", chunk=c), ["k", "t"], ["position", "P"]),
            (lambda c: H.histogram_filter(df, "k", ["t"], "m", ["x", "y", "z", "x"], chunk=c), ["k", "step"], ["belief"])]
    for run, names, values in runs:
        plain, chunked = ({tuple(r[n] for n in names): [r[v] for v in values] for r in run(c).collect()} for c in (None, "c"))
        assert len(plain) == len(rows) and set(plain) == set(chunked)
        for at, want in plain.items():
            for x, y in zip(want, chunked[at], strict=True):
                assert y == pytest.approx(x, rel=1e-9, abs=1e-9)


def test_chunked_filters_work_on_batches(spark):
    """H2-H4 by chunks start no Python group per key and chunk; groups that cross a batch, short or long, keep their state."""
    from tessera.operators import timeseries as H

    rows = [(k, t, t // (1 if k else 40), float(t * 7 % 11), 0.5 + t % 4, "xyz"[t * t % 3]) for k in range(3) for t in range(90)]
    df = spark.createDataFrame(rows, "k int, t int, c int, z double, r double, m string")
    runs = [(lambda c: H.kalman_cv(df, "k", ["t"], "z", "r", chunk=c), "t", ["position", "velocity", "P"]),
            (lambda c: H.kalman_fused(df, "k", ["t"], "z", "r", chunk=c), "t", ["position", "P"]),
            (lambda c: H.histogram_filter(df, "k", ["t"], "m", ["x", "y", "z", "x"], chunk=c), "step", ["belief"])]
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        for run, place, values in runs:
            assert "GroupsInPandas" not in run("c")._jdf.queryExecution().toString()
            plain, chunked = ({(r.k, r[place]): [r[v] for v in values] for r in run(c).collect()} for c in (None, "c"))
            assert len(plain) == len(rows) and set(plain) == set(chunked)
            for at, want in plain.items():
                for x, y in zip(want, chunked[at], strict=True):
                    assert y == pytest.approx(x, rel=1e-9, abs=1e-9)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


# ---------------------------------------------------------------- vector search

def _pairs(df):
    return {(r.qid, r.cid) for r in df.collect()}


def test_inverted_file_recall(spark):
    """The registered index query finds at least nine tenths of the exact neighbours (the given vectors have no clusters)."""
    from tessera import plans

    sf = "/root/testdata/sf0.01"
    got, exact = (_pairs(plans.queries()[name](spark, sf)) for name in ("t19_ann_search", "t18_nearest"))
    assert len(got) == len(exact) and len(got & exact) >= 0.9 * len(exact)


@pytest.mark.parametrize("metric", ["cosine", "l2", "dot"])
def test_pruned_search_is_exact_and_prunes(spark, metric):
    """On clustered vectors cells are left out, and the neighbours are those of brute force."""
    import numpy as np

    from tessera.operators import vector_index as VI

    rng = np.random.default_rng(4)
    centres = rng.normal(size=(12, 8)) * 8
    x = np.concatenate([c + rng.normal(size=(25, 8)) * 0.2 for c in centres])
    x = np.concatenate([x, x[:5], np.zeros((2, 8))])  # ties and zero vectors
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id long, v array<double>")
    got = V.nearest(df, df, 4, metric, qid="id", cid="id", vec="v", exclude_self=True, block_rows=16)
    scores = VI.scores(x, x, metric)
    for q, rows in _by_query(got).items():
        order = sorted((i for i in range(len(x)) if i != q), key=lambda i: (-round(scores[q, i], 9), i))[:4]
        assert sorted(round(scores[q, c], 6) for c in rows) == sorted(round(scores[q, c], 6) for c in order)
    cells, postings = VI.build(df, metric, 16)
    _, more = VI.exact_visits(df, postings, cells, 4, metric, True, 16)
    pairs = VI.visit_blocks(more, cells, 16)[1].count()
    blocks = more.select("cell").distinct().count()
    if metric != "dot":
        assert pairs < 0.5 * blocks * len(cells.sizes)
    assert V.nearest(df, df.limit(0), 4, metric, qid="id", cid="id", vec="v").collect() == []


@pytest.mark.parametrize("exclude_self", [False, True])
def test_top_rows_leave_out_what_is_below_the_best_so_far(exclude_self):
    """Tile by tile, with the best scores so far as a bound, the best rows are those of all columns; ties, repeated ids and few columns."""
    import numpy as np

    from tessera.operators import vector_index as VI

    rng, k = np.random.default_rng(3), 4
    qids, cids = rng.integers(0, 30, 25), rng.integers(0, 30, 90)
    all_scores = rng.integers(0, 8, (25, 90)).astype(float)
    best, found, taken = np.full((25, k), -np.inf), [], []
    for cols in np.split(np.arange(90), [2, 40, 41, 70]):
        row, col, score = VI.top_rows(qids, cids[cols], all_scores[:, cols], k, exclude_self, best[:, 0])
        best = VI.raised(best, row, score)
        found += zip(row.tolist(), (-score).tolist(), cids[cols][col].tolist())
        taken.append(len(row))
    for r in range(25):
        want = sorted((-s, c) for s, c in zip(all_scores[r].tolist(), cids.tolist()) if not (exclude_self and c == qids[r]))[:k]
        assert sorted(f[1:] for f in found if f[0] == r)[:k] == want
        assert sorted(best[r]) == sorted(-s for s, _ in want)
    assert taken[3] < 25 * k  # far from the best of the tile for every row


def test_search_moves_a_bounded_number_of_copies(spark):
    """Vectors without clusters: every query visits every cell, yet a row moves to a few groups only."""
    import numpy as np

    from tessera.operators import vector_index as VI

    cells = VI.Cells(np.zeros((400, 2)), np.zeros(400), np.full(400, 32.0), False)
    rows = VI.group_rows(cells.sizes.sum(), 32)
    first, many = VI.cell_groups(cells, rows)
    assert max(first) < 2 * VI.GROUPS and set(many) == {1} and all(first.count(g) * 32 <= rows for g in set(first))
    cells.sizes[7] = 10 * rows  # a cell that is cut has groups of its own
    first, many = VI.cell_groups(cells, rows)
    assert many[7] == 10 and first[8] == first[7] + 10 and first[6] < first[7]
    x = np.random.default_rng(1).normal(size=(1200, 6))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id long, v array<double>")
    index, postings = VI.build(df, "l2", 60)
    _, more = VI.exact_visits(df, postings, index, 3, "l2", True, 4)
    blocks = VI.visit_blocks(more, index, 4)[0].select("block").distinct().count()
    assert blocks <= 4 * VI.GROUPS
    want = np.argsort(VI.scores(x, x, "l2") - np.eye(1200) * 1e9, 1)[:, ::-1][:, :3]
    got = _by_query(V.nearest(df, df, 3, "l2", qid="id", cid="id", vec="v", exclude_self=True, block_rows=4))
    assert all(set(got[q]) == set(want[q]) for q in range(1200))


def _by_query(df):
    found = {}
    for r in df.collect():
        found.setdefault(r.qid, []).append(r.cid)
    return found


# ---------------------------------------------------------------- n-grams

@pytest.mark.parametrize("n", [1, 2, 3, 5])
@pytest.mark.parametrize("chunk", [1, 40, 10**6])
def test_ngrams_counted_by_chunks(spark, n, chunk):
    """Equal to one row per event, added up: null, empty and repeated texts, null tokens, texts of any length."""
    rng = random.Random(n)
    texts = [None, [], [], ["a"], ["a", None, "b"], *[[rng.choice(["a", "b", "", "_UNK_", "\u00e9"]) for _ in range(rng.randint(0, 9))] for _ in range(300)]]
    df = spark.createDataFrame([(t,) for t in texts], "tokens array<string>").repartition(3)
    want = T.ngram_events(df, "tokens", n).groupBy("prefix", "token").count()
    assert sorted(map(repr, map(tuple, T.ngram_counts(df, "tokens", n, chunk).collect()))) == sorted(map(repr, map(tuple, want.collect())))
    assert T.ngram_counts(df.limit(0), "tokens", n).collect() == []


def test_kneser_ney_by_hand_and_its_shuffles(spark):
    rng = random.Random(4)
    docs = [[rng.choice("abc") for _ in range(rng.randint(0, 8))] for _ in range(30)]
    df = spark.createDataFrame([(t,) for t in docs], "tokens array<string>")
    grams = {}
    for t in docs:
        padded = ["_UNK_"] * 2 + t + ["_EOS_"]
        for i in range(2, len(padded)):
            g = tuple(padded[i - 2 : i + 1])
            grams[g] = grams.get(g, 0) + 1
    two = {}
    for g in grams:
        two[g[1:]] = two.get(g[1:], 0) + 1
    one = {w: sum(g[1] == w for g in two) / len(two) for _, w in two}

    def step(counts, lower):
        per = {}
        for g, c in counts.items():
            per.setdefault(g[:-1], []).append(c)
        return {g: (max(c - 0.75, 0) + 0.75 * len(per[g[:-1]]) * lower[g[1:]]) / sum(per[g[:-1]]) for g, c in counts.items()}

    want = step(grams, step(two, {(w,): p for w, p in one.items()}))
    kn = T.kneser_ney(df, "tokens", 3)
    assert {(*r.prefix.split(" "), r.token): r.p for r in kn.collect()} == pytest.approx(want)
    # sums per prefix go without another shuffle of the n-grams
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        kn = T.kneser_ney(df, "tokens", 3)
        shuffles = [d._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") for d in (kn, kn.groupBy("prefix").agg(F.sum("p")))]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert shuffles[0] == shuffles[1]


def test_ngram_models_shuffle_ngrams_once_or_twice(spark):
    """Perplexity moves the trigrams of both sides once; Kneser-Ney finds them dealt, and moves them by their prefix."""
    import math

    def exchanges(df, *columns):
        plan = df._jdf.queryExecution().executedPlan().toString()
        return sum(all(c in line for c in columns) for line in plan.splitlines() if "Exchange hashpartitioning" in line)

    rng = random.Random(9)
    train, test = ([[rng.choice("abcd") for _ in range(rng.randint(0, 9))] for _ in range(n)] for n in (40, 15))
    train_df, test_df = (spark.createDataFrame([(t,) for t in d], "tokens array<string>").repartition(3) for d in (train, test))

    def grams(docs):
        return Counter(tuple((["_UNK_"] * 2 + t + ["_EOS_"])[i : i + 3]) for t in docs for i in range(len(t) + 1))

    seen, asked = grams(train), grams(test)
    total, kinds = Counter(), Counter()
    for g, c in seen.items():
        total[g[:2]] += c
        kinds[g[:2]] += 1
    V = len({g[2] for g in seen})

    def p(g, smoothing):
        if smoothing == "mle":
            return seen[g] / total[g[:2]] if seen[g] else 0.0
        if g[:2] not in total:
            return 1 / V
        known = (total[g[:2]] + kinds[g[:2]]) / (total[g[:2]] + V)
        return (seen[g] + 1) / (total[g[:2]] + V) if seen[g] else max(0.0, 1 - known) / max(1, V - kinds[g[:2]])

    for smoothing in ("mle", "laplace"):
        logs = [c * max(math.log(p(g, smoothing)), T.MIN_LOGPROB) if p(g, smoothing) else c * T.MIN_LOGPROB for g, c in asked.items()]
        for counts in (T.ngram_counts(train_df, "tokens", 3), T.ngram_parts(train_df, "tokens", 3, 7)):
            got = T.perplexity(counts, test_df, "tokens", 3, smoothing, train=train_df).first()
            assert got["log_perplexity"] == pytest.approx(-sum(logs) / asked.total()) and got["n_tokens"] == asked.total()
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert exchanges(T.perplexity(T.ngram_parts(train_df, "tokens", 3), test_df, "tokens", 3)) == 1
        kn = T.kneser_ney(train_df, "tokens", 3)
        assert (exchanges(kn, "_h#", "token#"), exchanges(kn, "prefix#")) == (1, 2)  # the bigrams to the trigrams; both orders by prefix
        assert not [t for t in spark.catalog.listTables() if t.name.startswith("tessera_")]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


# ---------------------------------------------------------------- hot keys

@pytest.fixture(scope="module")
def hot(spark):
    """A key with two thirds of all rows, a null key, repeated times, nulls and a constant stretch."""
    rng = random.Random(6)
    rows = []
    for i in range(240):
        key = "hot" if i % 3 else rng.choice(["a", "b", None])
        second = rng.randrange(0, 20 * 86400) // 600 * 600
        value = None if i % 17 == 0 else 5.1 if second < 2 * 86400 else round(rng.random() * 9, 2)
        rows.append((i, key, second, value))
    df = spark.createDataFrame(rows, "id long, k string, s long, v double")
    return df.select("id", "k", F.timestamp_seconds("s").alias("ts"), "v").cache()


@pytest.mark.parametrize("blocks", [1, 2, 24])
def test_rolling_windows_by_blocks(hot, blocks):
    from pyspark.sql import Window

    w = Window.partitionBy("k").orderBy(F.unix_micros("ts")).rangeBetween(-2 * 86_400_000_000, 0)
    want = {r.id: r for r in hot.select("id", F.avg("v").over(w).alias("m"), F.stddev_samp("v").over(w).alias("s")).collect()}
    got = W.rolling_stats(hot, "k", "ts", "v", 2, blocks).collect()
    assert len(got) == len(want)
    for r in got:
        m, s = want[r.id].m, want[r.id].s
        assert r.roll_mean == (m if m is None else pytest.approx(m, abs=1e-9))
        assert (r.roll_std is None) == (s is None) and (s is None or r.roll_std == pytest.approx(s, abs=1e-9))


def test_orders_of_one_hot_item(spark):
    """An item that every order asks for: sequential result, whatever the block."""
    rng = random.Random(2)
    lines = [(o, "hot", rng.randint(1, 4)) for o in range(60)] + [(o, rng.choice("xy"), rng.randint(1, 9)) for o in range(60)]
    stock = {"hot": 70, "x": 60, "y": 50}
    left, want = dict(stock), {}
    for o in range(60):
        own = {}
        for k, i, q in lines:
            if k == o:
                own[i] = own.get(i, 0) + q
        ok = all(q <= left[i] for i, q in own.items())
        for i, q in own.items():
            left[i] -= q if ok else 0
        want[o] = "success" if ok else "insufficient_stock"
    df = spark.createDataFrame(lines, "order_id long, item_id string, qty long")
    st = spark.createDataFrame(list(stock.items()), "item_id string, quantity_in_stock long")
    assert {r.order_id: r.status for r in W.apply_orders(df, st, block=7).collect()} == want


@pytest.mark.parametrize("rest", [10, 500])
def test_order_rounds_move_open_rows_only(spark, monkeypatch, rest):
    """Orders beyond the opening stock never enter the rounds, and the kept rows shrink from cut to cut."""
    rng = random.Random(5)
    lines = [(o, rng.randint(0, 19), rng.randint(1, 40)) for o in range(120) for _ in range(2)]
    stock = {i: rng.randint(20, 60) for i in range(20)}
    left, want, hopeful = dict(stock), {}, 0
    for o in range(120):
        own = {}
        for k, i, q in lines:
            if k == o:
                own[i] = own.get(i, 0) + q
        hopeful += len(own) if all(q <= stock[i] for i, q in own.items()) else 0
        ok = all(q <= left[i] for i, q in own.items())
        for i, q in own.items():
            left[i] -= q if ok else 0
        want[o] = "success" if ok else "insufficient_stock"
    kept, cut = [], W.cut_lineage

    def counting(df, *args):
        df = cut(df, *args)
        if "_used" in df.columns:
            kept.append(df.count())
        return df

    monkeypatch.setattr(W, "cut_lineage", counting)
    df = spark.createDataFrame(lines, "order_id long, item_id long, qty long")
    st = spark.createDataFrame(list(stock.items()), "item_id long, quantity_in_stock long")
    assert {r.order_id: r.status for r in W.apply_orders(df, st, block=7, rest=rest).collect()} == want
    assert kept[0] == hopeful and kept == sorted(kept, reverse=True) and kept[-1] <= rest


def test_order_stock_named_twice(spark):
    """A stock row that comes twice ends the rounds too (the lines count twice, as in the SQL's join)."""
    df = spark.createDataFrame([(1, 7, 3), (2, 7, 1)], "order_id long, item_id long, qty long")
    st = spark.createDataFrame([(7, 5), (7, 5)], "item_id long, quantity_in_stock long")
    got = {r.order_id: r.status for r in W.apply_orders(df, st, rest=0).collect()}
    assert got == {1: "insufficient_stock", 2: "success"}


def test_long_trajectories_and_series_by_chunks(spark):
    rng = random.Random(3)
    rows = [(k, t, t // 7, *(rng.random() for _ in range(4))) for k in ("a", None) for t in range(40)]
    df = spark.createDataFrame(rows, "k string, t long, c long, p double, q double, v double, s double")
    runs = (lambda c: W.gae(df, "k", "t", "p", "q", "v", "s", 0.9, 0.8, chunk=c).select("k", "t", "advantage", "returns"),
            lambda c: W.acf(df, "k", "t", "v", [1, 9], chunk=c).select("k", "lag", "acf"))
    for run in runs:
        plain, chunked = ({tuple(r)[:2]: tuple(r)[2:] for r in run(c).collect()} for c in (None, "c"))
        assert set(plain) == set(chunked)
        assert all(chunked[k] == pytest.approx(x, abs=1e-9) for k, x in plain.items())


@pytest.mark.parametrize("partitions", [1, 9])
def test_segmented_sums(spark, partitions):
    from tessera.operators.ranking import segmented_cumsum

    rows = [("hot" if i % 3 else f"s{i % 7}", i, float(i % 5 + 1)) for i in range(200)]
    want, run = {}, {}
    for s, i, x in sorted(rows):
        run[s] = run.get(s, 0.0) + x
        want[s, i] = run[s]
    got = segmented_cumsum(spark.createDataFrame(rows, "s string, i long, x double"), "s", ["i"], "x", partitions).collect()
    assert {(r.s, r.i): r._upto for r in got} == want and all(r._before == r._upto - r.x for r in got)


# ---------------------------------------------------------------- features, sampling

def test_signed_hash(spark):
    """Published MurmurHash3 values; signs and sums of the buckets."""
    known = {b"": 0, b"test": 0xBA6BD213, b"Hello, world!": 0xC0363E43, b"The quick brown fox jumps over the lazy dog": 0x2E4FF723}
    assert {k: FE.murmur3(k) & 0xFFFFFFFF for k in known} == known
    rows = [(1, "dog", "blue", 2.5), (2, "dog", None, 0.0), (3, None, None, None)]
    df = spark.createDataFrame(rows, "id long, a string, b string, x double")
    for n in (2, 1024):
        got = {r.id: r.features for r in FE.hash_features(df, ["a", "b", "x"], n).collect()}
        for i, a, b, x in rows:
            want = {}
            for name, value in (("a=" + (a or ""), 1.0 if a else None), ("b=" + (b or ""), 1.0 if b else None), ("x", x)):
                if value:
                    h = FE.murmur3(name.encode())
                    want[abs(h) % n] = want.get(abs(h) % n, 0.0) + (value if h >= 0 else -value)
            assert got[i] == {k: v for k, v in want.items() if v}


def test_tabular_fill_is_the_exact_median(spark):
    from pyspark.ml.functions import vector_to_array

    values = [1.0, 2.0, 100.0, 3.0, None, float("nan")]
    train = spark.createDataFrame([("u", v, 7.0) for v in values], "c string, v double, w double")
    filled = [2.5 if v is None or v != v else v for v in values]
    mean = sum(filled) / 6
    dev = (sum((v - mean) ** 2 for v in filled) / 6) ** 0.5
    model = FE.fit_tabular(train, ["c"], ["v", "w"])
    test = spark.createDataFrame([("new", None, 7.0), ("u", 4.0, 9.0)], "c string, v double, w double")
    got = [r.f[-2:] for r in model.transform(test).select(vector_to_array("features").alias("f")).collect()]
    assert got[0] == pytest.approx([(2.5 - mean) / dev, 0.0]) and got[1] == pytest.approx([(4.0 - mean) / dev, 2.0])


def test_cmixup_partners_follow_the_label_distance(spark):
    """The share of partners per distance is that of the weights; the draw does not depend on the partitioning."""
    import math

    ys = [float(i % 10) for i in range(3000)]
    df = spark.createDataFrame(list(enumerate(ys)), "k long, y double")
    got = {r.k: r for r in S.cmixup_partners(df.repartition(1), "k", "y", 3).collect()}
    again = {r.k: r for r in S.cmixup_partners(df.repartition(8, "y"), "k", "y", 3).collect()}
    assert got == again and set(got) == set(range(3000))
    assert all(r.partner != k and r.label_gap == abs(ys[k] - ys[r.partner]) for k, r in got.items())
    n = len(ys)
    mean = sum(ys) / n
    sigma = (sum((y - mean) ** 2 for y in ys) / (n - 1)) ** 0.5 / 2
    for label in (0.0, 5.0):
        weights = {z: 300 * math.exp(-((z - label) ** 2) / 2 / sigma**2) for z in map(float, range(10))}
        drawn = [ys[got[k].partner] for k in range(n) if ys[k] == label]
        for z, w in weights.items():
            share = w / sum(weights.values())
            assert abs(drawn.count(z) / len(drawn) - share) < 4 * (share * (1 - share) / len(drawn)) ** 0.5 + 0.01
    alone = spark.createDataFrame([(1, 2.0), (2, None)], "k long, y double")
    assert S.cmixup_partners(alone, "k", "y").collect() == []


def test_cmixup_joins_few_proposals(spark):
    """A proposal that passes at the far end of its cell is a row's last: about one or two of 16 are joined."""
    from pyspark.sql import functions as F

    df = spark.createDataFrame([(i, float(i % 97)) for i in range(500)], "k long, _y double")
    cells = [{"lo": float(c), "hi": c + 6.0, "n": 36, "first": 36 * (c // 7) + 1} for c in range(0, 97, 7)]
    propose = S._proposals(cells, 28.0)
    early, late = (S._drawn(df, propose, "k", 3, 0, late) for late in (False, True))
    sizes = {r.k: r.n for r in early.select("k", F.size("_d").alias("n")).collect()}
    assert set(sizes) == set(range(500)) and 1 <= sum(sizes.values()) / 500 < 3
    for r in late.select("k", F.size("_d").alias("n")).collect():
        assert sizes[r.k] + r.n == S.PROPOSALS


def test_cmixup_proposals_are_tested_in_one_pass(spark):
    """The luck of a proposal is its keyed hash, and no row is taken through a lambda per proposal."""
    df = spark.createDataFrame([(f"k{i}", float(i % 50)) for i in range(200)], "k string, _y double")
    cells = [{"lo": float(c), "hi": c + 4.0, "n": 20, "first": 4 * c + 1} for c in range(0, 50, 5)]
    early = S._drawn(df, S._proposals(cells, 10.0), "k", 3, 2, False)
    assert "lambdafunction" not in early._jdf.queryExecution().optimizedPlan().toString()
    luck = F.pmod(F.xxhash64(F.lit(3), F.lit(2), "_m", "k", F.lit("luck")), F.lit(1 << 40)) / float(1 << 40)
    met = early.select("k", "_y", F.inline("_d"))
    assert met.where(F.col("_luck") != luck).count() == 0
    own = [(r._place - 1) // 4 // 5 * 5 for r in met.collect()]
    assert all(abs(r._gap - max(0, c - r._y, r._y - c - 4) / 10) < 1e-12 for r, c in zip(met.collect(), own))
    assert all(r._m == k for r in early.collect() for k, r in enumerate(r._d))


def test_corpus_bleu_shuffles_texts_only(spark):
    """Rows of one key, null included, are one text for the clipping; n-grams are no rows of a shuffle."""
    from tessera.operators import text as T

    rows = [(1, "a b a c", "a a a b"), (None, "x y", "x"), (1, "a d", "d a a"), (None, None, "y x y"), (2, "  p@@ q r ", "pq r"), (3, "", None)]
    df = spark.createDataFrame(rows, "k int, ref string, hyp string")
    got = T.corpus_bleu(df, "k", "ref", "hyp").first()
    assert (got.hyp_len, got.ref_len) == (13.0, 10.0)
    assert [got[f"match{n}"] for n in (1, 2, 3, 4)] == [9.0, 3.0, 0.0, 0.0]
    assert [got[f"total{n}"] for n in (1, 2, 3, 4)] == [13.0, 8.0, 4.0, 1.0]
    assert "Generate" not in T.clipped_matches(df, "k", "ref", "hyp")._jdf.queryExecution().toString()


@pytest.mark.parametrize("name", ["q11_search", "m9_tree_models", "m13_compare_regressors"])
def test_fits_read_the_joined_frame_once(spark, monkeypatch, name):
    """What the estimators are given is kept: their passes over the data do not join again."""
    import __spark_entry__ as entry
    from table_dirs import SF_SMALL
    from tessera.operators import models as M

    given = []

    class Stop(Exception):
        pass

    def stop(df):
        given.append(df)
        raise Stop

    class Fit:
        def fit(self, df):
            stop(df)

    monkeypatch.setattr(M, "search", lambda est, grid, ev, df, **_: stop(df))
    monkeypatch.setattr(M, "compare_regressors", lambda train, test, *_: stop(train.unionByName(test)))
    monkeypatch.setattr(M, "tree_models", lambda *_, **__: Fit())
    with pytest.raises(Stop):
        entry.queries()[name](spark, SF_SMALL)
    plan = given[0]._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and "parquet" not in plan.lower()
    t = SF_SMALL
    parts = spark.read.parquet(f"{t}/part.parquet").select(F.col("p_partkey").alias("l_partkey"))
    assert given[0].count() == spark.read.parquet(f"{t}/lineitem.parquet").join(parts, "l_partkey").count()


def test_stream_kalman_folds_in_order_without_sorting_rows(monkeypatch):
    """One key's micro-batch in several unsorted parts: the order is that of the columns; the rows are not sorted as a table."""
    import pandas as pd

    from tessera.streaming.jobs import stream_kalman

    class Stream:
        def groupBy(self, key):
            return self

        def applyInPandasWithState(self, fold, *_):
            return fold

    class State:
        exists = False

        def update(self, value):
            self.value = value

    rows = pd.DataFrame({"u": 5, "ts": pd.to_datetime(["2024-01-02", "2024-01-01", "2024-01-02", "2024-01-03"]),
                         "event_id": [4, 9, 3, 1], "z": [1.0, 2.0, 4.0, 8.0], "R": [1.0, 3.0, 1.0, 3.0]})
    want, x, p = [], 50.0, 10.0
    for e, z, r in [(9, 2.0, 3.0), (3, 4.0, 1.0), (4, 1.0, 1.0), (1, 8.0, 3.0)]:
        gain = p / (p + r)
        x, p = x + gain * (z - x), (1 - gain) * p
        want.append((e, x, p))
    monkeypatch.setattr(pd.DataFrame, "sort_values", None)
    fold, state = stream_kalman(Stream(), "u", ["ts", "event_id"], "z", "R", 50.0, 10.0), State()
    (got,) = fold((5,), iter([rows.iloc[:3], rows.iloc[:0], rows.iloc[3:]]), state)
    assert list(got[["event_id", "x", "P"]].itertuples(index=False, name=None)) == want and state.value == want[-1][1:]
