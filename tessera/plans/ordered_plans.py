"""Window / ordered queries (W1-W9, H5) on events."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.operators import ordered as W
from tessera.plans.common import DAILY_SQL, PRODUCT_LOG_SQL, daily, product_log
from tessera.plans.registry import query
from tessera.session import Tables


@query("w1_add_lag_wrap", f"""
WITH {DAILY_SQL}
SELECT series, day, round(actual, 6) AS actual,
       round(coalesce(lag(actual) OVER (PARTITION BY series ORDER BY day),
                      last_value(actual) OVER (PARTITION BY series ORDER BY day
                                               ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)), 6) AS yesterday
FROM daily
""")
def w1_add_lag_wrap(spark, sf_dir):
    d = W.add_lag(daily(Tables(spark, sf_dir)), "series", "day", "actual", "yesterday", wrap=True)
    return d.select("series", "day", F.round("actual", 6).alias("actual"), F.round("yesterday", 6).alias("yesterday"))


@query("w1_add_lag_chunked", """
SELECT event_id, user_id, value, lag(value) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS prev_value FROM events
""")
def w1_add_lag_chunked(spark, sf_dir):
    e = Tables(spark, sf_dir).events.select("event_id", "user_id", "value", "ts")
    e = e.withColumn("_day", F.to_date("ts"))
    return W.add_lag(e, "user_id", ["ts", "event_id"], "value", "prev_value", chunk="_day").select(
        "event_id", "user_id", "value", "prev_value")


@query("w2_interpolate_linear", """
WITH s AS (SELECT user_id, event_id, ts, CASE WHEN event_type = 'error' THEN 0 ELSE value END AS v,
                  row_number() OVER (PARTITION BY user_id ORDER BY ts) AS i FROM events),
k AS (SELECT *, CASE WHEN v IS NOT NULL AND v <> 0 THEN v END AS kv FROM s),
n AS (SELECT *,
   last_value(CASE WHEN kv IS NOT NULL THEN i END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS pi,
   last_value(kv IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS pv,
   first_value(CASE WHEN kv IS NOT NULL THEN i END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS ni,
   first_value(kv IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS nv
 FROM k)
SELECT event_id, round(CASE WHEN kv IS NOT NULL THEN kv WHEN pi IS NULL THEN NULL WHEN ni IS NULL THEN pv
                            ELSE pv + (nv - pv) * (i - pi) / (ni - pi) END, 6) AS v
FROM n
""")
def w2_interpolate_linear(spark, sf_dir):
    e = Tables(spark, sf_dir).events
    s = e.select("user_id", "event_id", "ts",
                 F.when(F.col("event_type") == "error", F.lit(0.0)).otherwise(F.col("value")).alias("v"))
    r = W.interpolate_linear(s.withColumn("_day", F.to_date("ts")), "user_id", "ts", "v", chunk="_day")
    return r.select("event_id", F.round("v", 6).alias("v"))


@query("w3_resample_mean", """
WITH a AS (SELECT user_id, CAST(date_trunc('day', ts) AS TIMESTAMP) AS period, avg(value) AS value FROM events GROUP BY ALL),
span AS (SELECT user_id, min(period) AS lo, max(period) AS hi FROM a GROUP BY user_id),
grid AS (SELECT user_id, unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS period FROM span)
SELECT g.user_id, g.period, round(a.value, 6) AS value FROM grid g LEFT JOIN a USING (user_id, period)
WHERE a.value IS NULL OR a.value <> 0
""")
def w3_resample_mean(spark, sf_dir):
    e = Tables(spark, sf_dir).events
    r = W.resample_mean(e, "user_id", "ts", "value", "day")
    return r.select("user_id", "period", F.round("value", 6).alias("value"))


@query("w3_drop_first", """
SELECT event_id FROM (SELECT event_id, row_number() OVER (PARTITION BY event_type ORDER BY ts) AS r FROM events) WHERE r > 24
""")
def w3_drop_first(spark, sf_dir):
    e = Tables(spark, sf_dir).events
    return W.drop_first(e, "event_type", "ts", 24).select("event_id")


@query("w4_running_balance", f"""
WITH {PRODUCT_LOG_SQL}
SELECT id, product_id, CAST(100 + sum(qty_delta) OVER (PARTITION BY product_id ORDER BY ts, id
                                             ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DOUBLE) AS balance
FROM product_log
""")
def w4_running_balance(spark, sf_dir):
    p = product_log(Tables(spark, sf_dir)).withColumn("_day", F.to_date("ts"))
    r = W.running_balance(p, "product_id", "ts", "id", "qty_delta", opening=100.0, chunk="_day")
    return r.select("id", "product_id", F.col("balance").cast("double").alias("balance"))


_ORDERS_SQL = """
WITH RECURSIVE lines AS (SELECT l_orderkey AS order_id, l_partkey AS item_id, l_quantity AS qty FROM lineitem),
stock AS (SELECT p_partkey AS item_id, CAST(p_size AS DOUBLE) AS quantity_in_stock FROM part WHERE p_brand <> 'Brand#25'),
j AS (SELECT l.*, s.quantity_in_stock FROM lines l LEFT JOIN stock s USING (item_id)),
per AS (SELECT order_id, count(*) FILTER (WHERE qty IS NULL OR qty <= 0) AS bad,
               count(*) FILTER (WHERE quantity_in_stock IS NULL) AS missing, count(*) AS n_lines FROM j GROUP BY order_id),
asked AS MATERIALIZED (SELECT order_id, item_id, sum(qty) AS qty, any_value(quantity_in_stock) AS s FROM j
          WHERE order_id IN (SELECT order_id FROM per WHERE bad = 0 AND missing = 0) GROUP BY ALL),
-- an order with a line beyond the opening stock fails whatever came before it
hopeful AS MATERIALIZED (SELECT order_id, list({'i': item_id, 'q': qty, 's': s}) AS lines, row_number() OVER (ORDER BY order_id) AS n
            FROM asked GROUP BY order_id HAVING bool_and(qty <= s)),
-- one order at a time: a map holds what the successful orders so far have used of each item
run AS (SELECT 0::BIGINT AS n, NULL::BIGINT AS order_id, false AS ok, MAP([0::BIGINT], [0::DOUBLE]) AS used
        UNION ALL
        SELECT h.n, h.order_id, z.ok, CASE WHEN z.ok THEN map_concat(r.used, map(list_transform(h.lines, lambda x: x.i),
                 list_transform(h.lines, lambda x: x.q + coalesce(r.used[x.i], 0)))) ELSE r.used END
        FROM run r JOIN hopeful h ON h.n = r.n + 1,
             LATERAL (SELECT len(list_filter(h.lines, lambda x: x.q > x.s - coalesce(r.used[x.i], 0))) = 0 AS ok) z),
st AS (SELECT per.order_id, n_lines, CASE WHEN bad > 0 THEN 'invalid_request' WHEN missing > 0 THEN 'no_match'
              WHEN run.ok THEN 'success' ELSE 'insufficient_stock' END AS status FROM per LEFT JOIN run USING (order_id))
"""


def _order_inputs(spark, sf_dir):
    t = Tables(spark, sf_dir)
    lines = t.lineitem.select(F.col("l_orderkey").alias("order_id"), F.col("l_partkey").alias("item_id"),
                              F.col("l_quantity").alias("qty"))
    stock = t.part.where(F.col("p_brand") != "Brand#25").select(
        F.col("p_partkey").alias("item_id"), F.col("p_size").cast("double").alias("quantity_in_stock"))
    return lines, stock


@query("w5_apply_orders", _ORDERS_SQL + "SELECT * FROM st")
def w5_apply_orders(spark, sf_dir):
    lines, stock = _order_inputs(spark, sf_dir)
    return W.apply_orders(lines, stock)


@query("w5_stock_after", _ORDERS_SQL + """
, d AS (SELECT item_id, sum(qty) AS dq FROM lines WHERE order_id IN (SELECT order_id FROM st WHERE status = 'success')
        GROUP BY item_id)
SELECT s.item_id, s.quantity_in_stock - coalesce(d.dq, 0) AS quantity_in_stock FROM stock s LEFT JOIN d USING (item_id)
""")
def w5_stock_after(spark, sf_dir):
    lines, stock = _order_inputs(spark, sf_dir)
    return W.stock_after(lines, stock, W.apply_orders(lines, stock))


@query("w6_rolling_stats", """
SELECT event_id, round(avg(value) OVER w, 6) AS roll_mean, round(stddev_samp(value) OVER w, 6) AS roll_std,
       round((value - avg(value) OVER w) / stddev_samp(value) OVER w, 6) AS z
FROM events WINDOW w AS (PARTITION BY user_id ORDER BY epoch_us(ts) RANGE BETWEEN 604800000000 PRECEDING AND CURRENT ROW)
""")
def w6_rolling_stats(spark, sf_dir):
    e = Tables(spark, sf_dir).events.select("event_id", "user_id", "ts", "value")
    r = W.rolling_stats(e, "user_id", "ts", "value", 7)
    return r.select("event_id", *[F.round(c, 6).alias(c) for c in ("roll_mean", "roll_std", "z")])


_TRAJ_SQL = """
traj AS (SELECT user_id, CAST(ts AS DATE) AS day, event_id, ts, ln(1 + value) / 10 AS r,
                row_number() OVER (PARTITION BY user_id, CAST(ts AS DATE) ORDER BY ts) - 1 AS t FROM events)
"""


def _traj(spark, sf_dir):
    e = Tables(spark, sf_dir).events
    # reward = log1p(value) / 10: a non-terminating decimal, so 6-digit rounding never sits on a tie
    return e.select("user_id", F.to_date("ts").alias("day"), "event_id", "ts", (F.log1p("value") / 10).alias("r"))


_RETURNS_SQL = f"""
WITH {_TRAJ_SQL}
SELECT a.event_id, round(sum(power(0.9, b.t - a.t) * b.r), 6) AS G
FROM traj a JOIN traj b ON a.user_id = b.user_id AND a.day = b.day AND b.t >= a.t GROUP BY a.event_id
"""


@query("w7_discounted_returns", _RETURNS_SQL)
def w7_discounted_returns(spark, sf_dir):
    r = W.discounted_returns(_traj(spark, sf_dir), ["user_id", "day"], "ts", "r", 0.9)
    return r.select("event_id", F.round("G", 6).alias("G"))


@query("w7_discounted_returns_blocked", _RETURNS_SQL)
def w7_discounted_returns_blocked(spark, sf_dir):
    """Same as W7 with 2-row blocks: exercises the block recursion (3 levels for ~10 steps)."""
    r = W.discounted_returns(_traj(spark, sf_dir), ["user_id", "day"], "ts", "r", 0.9, block=2)
    return r.select("event_id", F.round("G", 6).alias("G"))


@query("w7_discounted_returns_user", """
WITH s AS (SELECT user_id, event_id, value / 100.0 AS r, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS t
           FROM events)
SELECT a.event_id, round(sum(power(0.99, b.t - a.t) * b.r), 6) AS G
FROM s a JOIN s b ON a.user_id = b.user_id AND b.t >= a.t GROUP BY a.event_id
""")
def w7_discounted_returns_user(spark, sf_dir):
    """Whole user histories as trajectories, positions from day chunks (no user-wide window), 16-row blocks."""
    e = Tables(spark, sf_dir).events.select("user_id", "event_id", "ts", (F.col("value") / 100.0).alias("r"))
    e = e.withColumn("_day", F.to_date("ts"))
    r = W.discounted_returns(e, "user_id", ["ts", "event_id"], "r", 0.99, block=16, chunk="_day")
    return r.select("event_id", F.round("G", 6).alias("G"))


@query("w8_gae", f"""
WITH {_TRAJ_SQL},
x AS (SELECT *, -r AS logp, -value_ref AS ref_logp, r / 2 AS v FROM (SELECT *, r * 1.1 AS value_ref FROM traj)),
y AS (SELECT *, coalesce(lead(v) OVER (PARTITION BY user_id, day ORDER BY t), 0) AS next_v,
             lead(v) OVER (PARTITION BY user_id, day ORDER BY t) IS NULL AS is_last FROM x),
d AS (SELECT *, -0.1 * (logp - ref_logp) + CASE WHEN is_last THEN 1.0 ELSE 0 END AS reward FROM y),
dd AS (SELECT *, reward + 1.0 * next_v - v AS delta FROM d)
SELECT a.event_id, round(sum(power(0.95, b.t - a.t) * b.delta), 6) AS advantage,
       round(sum(power(0.95, b.t - a.t) * b.delta) + any_value(a.v), 6) AS returns
FROM dd a JOIN dd b ON a.user_id = b.user_id AND a.day = b.day AND b.t >= a.t GROUP BY a.event_id
""")
def w8_gae(spark, sf_dir):
    t = _traj(spark, sf_dir)
    t = t.select("*", (-F.col("r")).alias("logp"), (-(F.col("r") * 1.1)).alias("ref_logp"),
                 (F.col("r") / 2).alias("v"), F.lit(1.0).alias("score"))
    t = t.withColumn("_hour", F.hour("ts"))
    r = W.gae(t, ["user_id", "day"], "ts", "logp", "ref_logp", "v", "score", gamma=1.0, lam=0.95, kl_coef=0.1, chunk="_hour")
    return r.select("event_id", F.round("advantage", 6).alias("advantage"), F.round("returns", 6).alias("returns"))


@query("w9_transition_matrix", """
WITH p AS (SELECT event_type AS from_state, lead(event_type) OVER (PARTITION BY user_id ORDER BY ts) AS to_state FROM events),
c AS (SELECT from_state, to_state, count(*) AS n FROM p WHERE to_state IS NOT NULL GROUP BY ALL)
SELECT from_state, to_state, n, round(n / sum(n) OVER (PARTITION BY from_state), 9) AS p FROM c
""")
def w9_transition_matrix(spark, sf_dir):
    e = Tables(spark, sf_dir).events.withColumn("_day", F.to_date("ts"))
    r = W.transition_matrix(e, "user_id", ["ts", "event_id"], "event_type", chunk="_day")
    return r.withColumn("p", F.round("p", 9))


@query("h5_difference", f"""
WITH {DAILY_SQL}
SELECT series, day, round(actual - lag(actual) OVER (PARTITION BY series ORDER BY day), 6) AS actual_diff FROM daily
""")
def h5_difference(spark, sf_dir):
    d = daily(Tables(spark, sf_dir)).withColumn("_week", F.date_trunc("week", "day"))
    r = W.difference(d, "series", "day", "actual", chunk="_week")
    return r.select("series", "day", F.round("actual_diff", 6).alias("actual_diff"))


@query("h5_moving_average", f"""
WITH {DAILY_SQL}
SELECT series, day,
  round(CASE WHEN count(*) OVER w = 7 THEN avg(actual) OVER w END, 6) AS actual_ma7,
  round(CASE WHEN count(*) OVER w = 7 THEN stddev_samp(actual) OVER w END, 6) AS actual_std7
FROM daily WINDOW w AS (PARTITION BY series ORDER BY day ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)
""")
def h5_moving_average(spark, sf_dir):
    d = daily(Tables(spark, sf_dir)).withColumn("_week", F.date_trunc("week", "day"))
    r = W.moving_average(d, "series", "day", "actual", 7, with_std=True, chunk="_week")
    return r.select("series", "day", F.round("actual_ma7", 6).alias("actual_ma7"),
                    F.round("actual_std7", 6).alias("actual_std7"))


@query("h5_detrend", f"""
WITH {DAILY_SQL}, x AS (SELECT *, CAST(day - DATE '2024-01-01' AS DOUBLE) AS x FROM daily),
f AS (SELECT series, regr_slope(actual, x) AS b, regr_intercept(actual, x) AS a FROM x GROUP BY series)
SELECT series, day, round(actual - (a + b * x), 6) AS actual_detrended FROM x JOIN f USING (series)
""")
def h5_detrend(spark, sf_dir):
    d = daily(Tables(spark, sf_dir)).withColumn("x", F.datediff("day", F.lit("2024-01-01")).cast("double"))
    r = W.detrend(d, "series", "x", "actual")
    return r.select("series", "day", F.round("actual_detrended", 6).alias("actual_detrended"))


@query("h5_acf", f"""
WITH {DAILY_SQL}, m AS (SELECT series, avg(actual) AS m FROM daily GROUP BY series),
c AS (SELECT d.series, d.day, d.actual - m.m AS c FROM daily d JOIN m USING (series)),
l AS (SELECT series, c, lag(c, 1) OVER w AS l1, lag(c, 7) OVER w AS l7 FROM c WINDOW w AS (PARTITION BY series ORDER BY day))
SELECT series, 1 AS lag, round(sum(c * l1) / sum(c * c), 9) AS acf FROM l GROUP BY series
UNION ALL SELECT series, 7, round(sum(c * l7) / sum(c * c), 9) FROM l GROUP BY series
""")
def h5_acf(spark, sf_dir):
    d = daily(Tables(spark, sf_dir)).withColumn("_month", F.trunc("day", "month"))
    r = W.acf(d, "series", "day", "actual", [1, 7], chunk="_month")
    return r.withColumn("acf", F.round("acf", 9))
