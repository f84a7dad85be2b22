"""Source/sink, streaming, tokenizer, reward and image queries (A, S, T7-T9, T25, F8-F10).

Files are staged under the shared checkpoint folder (``scratch_path``) and
read back, so each query exercises the writer and the reader on whole tables.
"""

from __future__ import annotations

import io
import zipfile

import numpy as np
import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType

from tessera.functions import rewards as RW
from tessera.functions import text as FT
from tessera.functions.image import grayscale
from tessera.operators import sampling as S
from tessera.operators import tokenizer as TK
from tessera.plans.registry import query
from tessera.session import Tables
from tessera.sources import files as IO
from tessera.streaming import jobs as ST


@query("a1_csv_roundtrip", """
SELECT o_orderstatus, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM orders GROUP BY o_orderstatus
""")
def a1_csv_roundtrip(spark, sf_dir):
    o = Tables(spark, sf_dir).orders
    path = IO.scratch_path(spark, "orders-csv")
    IO.write_csv(o, path, header=True)
    back = IO.read_table(spark, path, "csv")
    return back.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total"))


@query("a1_tsv_explicit_schema", """
SELECT o_orderpriority, count(*) AS n, max(o_orderkey) AS max_key FROM orders GROUP BY o_orderpriority
""")
def a1_tsv_explicit_schema(spark, sf_dir):
    o = Tables(spark, sf_dir).orders.select("o_orderkey", "o_orderpriority")
    path = IO.scratch_path(spark, "orders-tsv")
    IO.write_csv(o, path, header=True, sep="\t")
    back = IO.read_table(spark, path, "tsv", schema="o_orderkey long, o_orderpriority string")
    return back.groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("n"), F.max("o_orderkey").alias("max_key"))


@query("a1_zipped_csv", "SELECT p_brand, count(*) AS n FROM part GROUP BY p_brand")
def a1_zipped_csv(spark, sf_dir):
    """part is written as one zip archive per partition (one CSV member each) and read back."""
    p = Tables(spark, sf_dir).part.select("p_partkey", "p_brand")

    def to_zip(it):
        for pdf in it:
            if len(pdf) == 0:
                continue
            buf = io.BytesIO()
            with zipfile.ZipFile(buf, "w", zipfile.ZIP_DEFLATED) as zf:
                zf.writestr("part.csv", pdf.to_csv(index=False))
            yield pd.DataFrame({"name": [f"part-{int(pdf['p_partkey'].iloc[0])}.zip"], "content": [buf.getvalue()]})

    zips = p.repartition(4, "p_partkey").mapInPandas(to_zip, "name string, content binary")
    path = IO.scratch_path(spark, "part-zip")
    IO.write_binaries(zips, "name", "content", path, as_files=True)
    back = IO.read_table(spark, path, "zip", schema="p_partkey long, p_brand string")
    return back.groupBy("p_brand").agg(F.count(F.lit(1)).alias("n"))


@query("a2_json_corpus", "SELECT item_id, length(text) AS n_chars FROM benchmark")
def a2_json_corpus(spark, sf_dir):
    b = Tables(spark, sf_dir).benchmark
    path = IO.scratch_path(spark, "bench-json")
    IO.write_json_documents(b, path)
    back = IO.read_json_corpus(spark, path, multiline=True, schema="item_id long, text string")
    return back.select("item_id", F.length("text").alias("n_chars"))


@query("a4_json_messages", """
SELECT event_id, user_id, event_type, value FROM events
""")
def a4_json_messages(spark, sf_dir):
    e = Tables(spark, sf_dir).events
    m = ST.to_json_messages(e, key="event_id")
    return m.select(F.get_json_object("value", "$.event_id").cast("long").alias("event_id"),
                    F.get_json_object("value", "$.user_id").cast("long").alias("user_id"),
                    F.get_json_object("value", "$.event_type").alias("event_type"),
                    F.get_json_object("value", "$.value").cast("double").alias("value"))


@F.pandas_udf(BinaryType())
def _vector_bmp(v: pd.Series) -> pd.Series:
    out = []
    for arr in v:
        x = np.asarray(arr, dtype=np.float64)[:64]
        lo, hi = x.min(), x.max()
        g = np.round((x - lo) / (hi - lo if hi > lo else 1.0) * 255).astype(np.uint8).reshape(8, 8)
        rgb = np.stack([g, 255 - g, g // 2], axis=-1)
        out.append(IO.bmp_bytes(rgb))
    return pd.Series(out)


@query("a5_f8_image_grayscale")
def a5_f8_image_grayscale(spark, sf_dir):
    """Each embedding drawn as an 8x8 colour BMP (A8 writer), read by the image source (A5),
    converted to gray (F8); the mean gray level per image is returned."""
    e = Tables(spark, sf_dir).embeddings
    imgs = e.select(F.format_string("vec-%d.bmp", "vec_id").alias("name"), _vector_bmp("embedding").alias("content"))
    path = IO.scratch_path(spark, "images")
    IO.write_binaries(imgs, "name", "content", path, as_files=True)
    back = IO.read_images(spark, path)
    g = back.select(F.col("image.origin").alias("origin"), F.col("image.height").alias("h"),
                    F.col("image.width").alias("w"),
                    grayscale(F.col("image.data"), F.col("image.nChannels")).alias("gray"))
    mean = F.aggregate(F.transform(F.sequence(F.lit(1), F.length("gray")),
                                   lambda i: F.conv(F.hex(F.substring("gray", i, 1)), 16, 10).cast("double")),
                       F.lit(0.0), lambda a, x: a + x) / F.length("gray")
    return g.select(F.regexp_extract("origin", r"vec-(\d+)\.bmp", 1).cast("long").alias("vec_id"), "h", "w",
                    mean.alias("mean_gray"))


@query("a7_write_csv", "SELECT toxic, count(*) AS n FROM labels GROUP BY toxic")
def a7_write_csv(spark, sf_dir):
    lab = Tables(spark, sf_dir).labels
    path = IO.scratch_path(spark, "labels-csv")
    IO.write_csv(lab, path, header=False, label="toxic")
    back = spark.read.csv(path, schema="toxic int, doc_id long, quality int")
    return back.groupBy("toxic").agg(F.count(F.lit(1)).alias("n"))


@query("a9_read_lines", r"""
SELECT count(*) AS n_lines, sum(length(line))::BIGINT AS n_chars
FROM (SELECT unnest(regexp_split_to_array(text, '\r\n|\r|\n')) AS line FROM documents)
""")
def a9_read_lines(spark, sf_dir):
    d = Tables(spark, sf_dir).documents
    path = IO.scratch_path(spark, "doc-lines")
    d.select("text").write.text(path)
    lines = IO.read_lines(spark, path)
    return lines.agg(F.count(F.lit(1)).alias("n_lines"), F.sum(F.length("value")).alias("n_chars"))


def _parallel_pairs(spark, sf_dir):
    c = Tables(spark, sf_dir).conversations
    u = c.where(F.col("role") == "user").select("conv_id", "turn", F.col("text").alias("src"))
    a = c.where(F.col("role") == "assistant").select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("dst"))
    return u.join(a, ["conv_id", "turn"]).select(
        "conv_id", "turn", F.regexp_replace("src", r"[\t\n]", " ").alias("src"),
        F.regexp_replace("dst", r"[\t\n]", " ").alias("dst"))


@query("a9_read_parallel")
def a9_read_parallel(spark, sf_dir):
    pairs = _parallel_pairs(spark, sf_dir)
    path = IO.scratch_path(spark, "parallel")
    pairs.select(F.concat_ws("\t", "src", "dst").alias("value")).write.text(path)
    back = IO.read_parallel(spark, path)
    return back.agg(F.count(F.lit(1)).alias("n_pairs"), F.sum(F.length("src")).alias("src_chars"),
                    F.sum(F.length("dst")).alias("dst_chars"))


@query("a10_feature_store_latest", """
SELECT user_id AS "index", arg_max(value, ts) AS value, arg_max(event_type, ts) AS event_type FROM events GROUP BY user_id
""")
def a10_feature_store_latest(spark, sf_dir):
    e = Tables(spark, sf_dir).events
    path = IO.scratch_path(spark, "features")
    cut = F.lit("2024-01-15 00:00:00").cast("timestamp_ntz")
    for part in (e.where(F.col("ts") < cut), e.where(F.col("ts") >= cut)):
        IO.write_features(part.select(F.col("user_id").alias("index"), "value", "event_type",
                                      F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("event_time")),
                          path, key="index", event_time="event_time")
    return IO.read_features(spark, path, key="index").select("index", "value", "event_type")


@query("a11_save_load_model")
def a11_save_load_model(spark, sf_dir):
    from tessera.operators import models as M
    li = Tables(spark, sf_dir).lineitem.withColumn("is_r", (F.col("l_returnflag") == "R").cast("double"))
    model = M.fraud_pipeline(["l_quantity", "l_discount", "l_tax"], label="is_r", num_trees=5).fit(li)
    path = IO.scratch_path(spark, "model")
    IO.save_model(model, path)
    loaded = IO.load_model(path)
    a = model.transform(li).select("l_orderkey", "l_linenumber", "l_partkey", F.col("prediction").alias("p1"))
    b = loaded.transform(li).select("l_orderkey", "l_linenumber", "l_partkey", F.col("prediction").alias("p2"))
    j = a.join(b, ["l_orderkey", "l_linenumber", "l_partkey"])
    return j.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("p1") != F.col("p2")).alias("n_diff"))


# ---------------------------------------------------------------- streaming

EVENT_SCHEMA = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"


def _stage_events(spark, sf_dir, files=8):
    e = Tables(spark, sf_dir).events
    path = IO.scratch_path(spark, "event-messages")
    ST.write_messages(e, path, files, order=["ts", "event_id"])
    return path


@query("s1_score_stream")
def s1_score_stream(spark, sf_dir):
    """Events replayed as JSON messages -> parsed -> saved pipeline -> append parquet sink."""
    from tessera.operators import models as M
    e = Tables(spark, sf_dir).events
    feats = ["value", "k"]
    train = e.withColumn("k", F.get_json_object("props", "$.k").cast("double")).withColumn(
        "label", (F.col("event_type") == "purchase").cast("double"))
    model = M.fraud_pipeline(feats, label="label", num_trees=5).fit(train)
    mpath = IO.scratch_path(spark, "stream-model")
    IO.save_model(model, mpath)
    src = _stage_events(spark, sf_dir)
    stream = ST.replay_stream(spark, src, max_files=1)
    parsed = ST.parse_messages(stream, EVENT_SCHEMA).withColumn("k", F.get_json_object("props", "$.k").cast("double"))
    scored = IO.load_model(mpath).transform(parsed).select("event_id", "user_id", "prediction")
    out, ck = IO.scratch_path(spark, "scored"), IO.scratch_path(spark, "scored-ckpt")
    q = ST.start_append(scored, ck, "parquet", out)
    q.awaitTermination()
    return spark.read.parquet(out)


@query("s3_stream_user_features")
def s3_stream_user_features(spark, sf_dir):
    src = _stage_events(spark, sf_dir)
    stream = ST.parse_messages(ST.replay_stream(spark, src, max_files=1), EVENT_SCHEMA).withColumn(
        "ts", F.col("ts").cast("timestamp"))
    feats = ST.stream_user_features(stream, "user_id", "ts", "value", "7 days", "1 day", "1 day")
    out, ck = IO.scratch_path(spark, "user-features"), IO.scratch_path(spark, "user-features-ckpt")
    ST.start_append(feats, ck, "parquet", out).awaitTermination()
    return spark.read.parquet(out)


@query("s4_stream_kalman")
def s4_stream_kalman(spark, sf_dir):
    """Online scalar Kalman per user with state kept across micro-batches (equals h1_kalman_scalar)."""
    src = _stage_events(spark, sf_dir)
    stream = ST.parse_messages(ST.replay_stream(spark, src, max_files=1), EVENT_SCHEMA).select(
        "event_id", "user_id", "ts", F.col("value").alias("z"),
        F.when(F.col("event_type").isin("click", "view"), 3.0).otherwise(1.0).alias("R"))
    k = ST.stream_kalman(stream, "user_id", ["ts", "event_id"], "z", "R", 50.0, 10.0)
    out, ck = IO.scratch_path(spark, "kalman"), IO.scratch_path(spark, "kalman-ckpt")
    ST.start_append(k, ck, "parquet", out).awaitTermination()
    return spark.read.parquet(out).select("event_id", F.round("P", 9).alias("P"), F.round("x", 6).alias("x"))


# ---------------------------------------------------------------- tokenizer, rewards

def _merge_table(spark, merges, special=()):
    vocab = TK.vocab_bytes(merges, special)
    rows = [(r, a, b, new, vocab[new].decode("utf-8", errors="replace")) for r, (a, b, new) in enumerate(merges)]
    return spark.createDataFrame(rows, "rank int, left int, right int, id int, token string")


@query("t7_bpe_train_raw")
def t7_bpe_train_raw(spark, sf_dir):
    """Byte-level BPE on the raw documents (each text one sequence), ties to the first-seen pair."""
    d = Tables(spark, sf_dir).documents
    merges = TK.bpe_train(d, "text", key="doc_id", pretokenize=False, tie="first_seen")
    return _merge_table(spark, merges)


@query("t8_bpe_train")
def t8_bpe_train(spark, sf_dir):
    """BPE on the documents with pre-tokenisation and special tokens, ties to the larger pair."""
    d = Tables(spark, sf_dir).documents
    merges = TK.bpe_train(d, "text", key="doc_id", pretokenize=True, tie="max_pair",
                          special_tokens=("<|endoftext|>",))
    return _merge_table(spark, merges, ("<|endoftext|>",))


@query("t9_bpe_roundtrip")
def t9_bpe_roundtrip(spark, sf_dir):
    """Encode every document with merges learnt on the documents, decode, compare."""
    t = Tables(spark, sf_dir)
    merges = TK.bpe_train(t.documents, "text", key="doc_id")
    enc = TK.bpe_encode(t.documents, "text", "doc_id", merges)
    dec = enc.select("doc_id", F.size("ids").alias("n_ids"), TK.bpe_decode("ids", merges, spark).alias("back"))
    j = dec.join(t.documents.select("doc_id", "text"), "doc_id")
    return j.select("doc_id", "n_ids", (F.col("back") == F.col("text")).alias("roundtrip_ok"))


@query("t25_prepare_parallel")
def t25_prepare_parallel(spark, sf_dir):
    """Parallel pairs from conversations: tokenise both sides, BPE per side, hold out pairs."""
    pairs = _parallel_pairs(spark, sf_dir).withColumn("_k", F.concat_ws("|", "conv_id", "turn"))
    tok = pairs.select("_k", FT.wordpunct("src").alias("src"), FT.wordpunct("dst").alias("dst"))
    split = S.split_exact(tok, "_k", (0.9, 0.1), "42", ("train", "dev"))
    train = split.where(F.col("split") == "train")
    m_src = TK.bpe_train(train, "src", key="_k")
    m_dst = TK.bpe_train(train, "dst", key="_k")
    src = TK.bpe_encode(split, "src", "_k", m_src).select("_k", F.size("ids").alias("src_ids"))
    dst = TK.bpe_encode(split, "dst", "_k", m_dst).select("_k", F.size("ids").alias("dst_ids"))
    coded = split.select("_k", "split").join(src, "_k").join(dst, "_k")
    return coded.groupBy("split").agg(
        F.count(F.lit(1)).alias("n"), F.sum("src_ids").alias("src_ids"), F.sum("dst_ids").alias("dst_ids")).withColumn(
        "src_merges", F.lit(len(m_src))).withColumn("dst_merges", F.lit(len(m_dst)))


def _completions(spark, sf_dir):
    """Countdown-style completions derived from conversations: numbers = first three turn lengths (0 for a turn
    that is missing), format by the fourth turn's role (``system`` where there is none)."""
    c = Tables(spark, sf_dir).conversations
    per = c.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", F.length("text").alias("n"), "role")))
                                   .alias("t"))
    a, b, d = (F.coalesce(F.try_element_at("t", F.lit(k + 1))["n"], F.lit(0)) for k in range(3))
    role = F.coalesce(F.try_element_at("t", F.lit(4))["role"], F.lit("system"))
    good_fmt = role != "system"
    eq = F.format_string("%d + %d - %d", a, b, d)
    body = F.when(good_fmt, F.concat(F.lit(" adding the first two and removing the third </think>\n<answer> "), eq,
                                     F.lit(" </answer>"))).otherwise(F.concat(F.lit("answer: "), eq))
    target = F.when(role == "user", a + b - d).otherwise(a + b - d + 1)
    return per.select("conv_id", body.alias("completion"), target.cast("string").alias("target"),
                      F.array(a, b, d).alias("nums"))


@query("f9_format_reward")
def f9_format_reward(spark, sf_dir):
    c = _completions(spark, sf_dir)
    return c.select("conv_id", RW.format_reward("completion").alias("reward"))


@query("f10_equation_reward")
def f10_equation_reward(spark, sf_dir):
    c = _completions(spark, sf_dir)
    r = c.select("conv_id", RW.format_reward("completion").alias("format"),
                 RW.equation_reward("completion", "target", "nums").alias("equation"))
    return r


@query("f10_group_reward_stats")
def f10_group_reward_stats(spark, sf_dir):
    """Rewards of the conversations with the same first role as one prompt's group: mean, deviation, advantage."""
    t = Tables(spark, sf_dir)
    first = t.conversations.groupBy("conv_id").agg(F.min_by("role", "turn").alias("prompt"))
    scored = _completions(spark, sf_dir).join(first, "conv_id").select(
        "conv_id", "prompt", (RW.format_reward("completion") + RW.equation_reward("completion", "target", "nums")).alias("reward"))
    r = RW.group_reward_stats(scored, "prompt", "reward")
    return r.select("conv_id", "prompt", "reward", *[F.round(c, 9).alias(c) for c in ("reward_mean", "reward_std", "advantage")])
