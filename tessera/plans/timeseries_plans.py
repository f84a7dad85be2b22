"""State-estimation queries (H1-H4) on events."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.operators import timeseries as H
from tessera.plans.registry import query
from tessera.session import Tables


def _sensor_rows(spark, sf_dir):
    e = Tables(spark, sf_dir).events
    # clicks and views are the "radar" (R = 3), every other event the "camera" (R = 1)
    return e.select("event_id", "user_id", "ts", F.col("value").alias("z"),
                    F.when(F.col("event_type").isin("click", "view"), 3.0).otherwise(1.0).alias("R"))


@query("h1_kalman_scalar", """
WITH s AS (SELECT event_id, user_id, ts, value AS z, CASE WHEN event_type IN ('click', 'view') THEN 3.0 ELSE 1.0 END AS R FROM events),
c AS (SELECT event_id, sum(1.0 / R) OVER w AS ir, sum(z / R) OVER w AS zr FROM s
      WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
SELECT event_id, round(1.0 / (0.1 + ir), 9) AS P, round((1.0 / (0.1 + ir)) * (50.0 / 10.0 + zr), 6) AS x FROM c
""")
def h1_kalman_scalar(spark, sf_dir):
    d = _sensor_rows(spark, sf_dir).withColumn("_day", F.to_date("ts"))
    r = H.kalman_scalar(d, "user_id", ["ts", "event_id"], "z", "R", 50.0, 10.0, chunk="_day")
    return r.select("event_id", F.round("P", 9).alias("P"), F.round("x", 6).alias("x"))


@query("h2_kalman_cv")
def h2_kalman_cv(spark, sf_dir):
    d = _sensor_rows(spark, sf_dir).withColumn("_day", F.to_date("ts"))
    r = H.kalman_cv(d, "user_id", ["ts", "event_id"], "z", "R", q=0.1, chunk="_day")
    return r.select("event_id", "user_id", "position", "velocity", "P")


@query("h3_kalman_fused")
def h3_kalman_fused(spark, sf_dir):
    e = Tables(spark, sf_dir).events.select(
        "event_id", "user_id", "ts", F.col("value").alias("a"),
        F.get_json_object("props", "$.k").cast("double").alias("b"),
        F.to_date("ts").alias("_day"))
    r = H.kalman_fused(e, "user_id", ["ts", "event_id"], "a", "b", chunk="_day")
    return r.select("event_id", "user_id", "position", "P")


@query("h4_histogram_filter")
def h4_histogram_filter(spark, sf_dir):
    """Each user's event types as landmark readings in a 5-cell cyclic world."""
    e = Tables(spark, sf_dir).events.select("user_id", "ts", "event_id", "event_type", F.to_date("ts").alias("_day"))
    world = ["signup", "click", "view", "purchase", "error"]
    return H.histogram_filter(e, "user_id", ["ts", "event_id"], "event_type", world, chunk="_day")
