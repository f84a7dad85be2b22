"""Stream = batch checks."""

import pytest
from pyspark.sql import functions as F

from table_dirs import SF_SMALL
import __spark_entry__ as entry


def test_stream_kalman_equals_batch(spark):
    qs = entry.queries()
    s = qs["s4_stream_kalman"](spark, SF_SMALL)
    b = qs["h1_kalman_scalar"](spark, SF_SMALL)
    assert s.count() == b.count()
    diff = s.alias("s").join(b.alias("b"), "event_id").where(
        (F.abs(F.col("s.x") - F.col("b.x")) > 1e-5) | (F.abs(F.col("s.P") - F.col("b.P")) > 1e-8))
    assert diff.count() == 0


def test_score_stream_covers_all_events(spark):
    out = entry.queries()["s1_score_stream"](spark, SF_SMALL)
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    assert out.count() == ev.count()
    assert out.select("event_id").distinct().count() == ev.count()


def test_stream_features_equal_batch_for_closed_windows(spark):
    from tessera.streaming.jobs import stream_user_features

    out = entry.queries()["s3_stream_user_features"](spark, SF_SMALL)
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet").withColumn("ts", F.col("ts").cast("timestamp"))
    batch = (ev.groupBy(F.window("ts", "7 days", "1 day").alias("w"), "user_id")
             .agg(F.avg("value").alias("mean"), F.count(F.lit(1)).alias("n"))
             .select("user_id", F.col("w.start").alias("window_start"), "mean", "n"))
    # every window that the final watermark has closed, and no other
    last = ev.agg((F.max("ts") - F.expr("INTERVAL 1 DAY")).alias("w")).first()["w"]
    closed = batch.where(F.col("window_start") + F.expr("INTERVAL 7 DAYS") <= F.lit(last))
    keys = ["user_id", "window_start"]
    assert sorted(map(tuple, out.select(*keys).collect())) == sorted(map(tuple, closed.select(*keys).collect()))
    j = out.join(batch, keys)
    assert j.count() == out.count() > 0
    assert j.where((out["n"] != batch["n"]) | (F.abs(out["mean"] - batch["mean"]) > 1e-9)).count() == 0
    del stream_user_features
