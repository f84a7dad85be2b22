"""Shapes of the reference's inputs derived from the driver tables (always in the query, never as files)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.session import Tables

# Event-sourced product log (id, product_id, action, qty_delta, unit_price, color, ts) from `events`:
# user_id is the product; purchase -> sale (negative delta), signup -> insert, view -> restock (no price),
# click/error -> price_update (delta 0).
PRODUCT_LOG_SQL = """
product_log AS (
  SELECT event_id AS id, user_id AS product_id,
         CASE event_type WHEN 'purchase' THEN 'sale' WHEN 'signup' THEN 'insert'
                         WHEN 'view' THEN 'restock' ELSE 'price_update' END AS action,
         CAST(CASE event_type WHEN 'purchase' THEN -(CAST(json_extract(props, '$.k') AS BIGINT) % 5 + 1)
                              WHEN 'signup' THEN 10 + CAST(json_extract(props, '$.k') AS BIGINT) % 7
                              WHEN 'view' THEN CAST(json_extract(props, '$.k') AS BIGINT) % 4 + 1
                              ELSE 0 END AS BIGINT) AS qty_delta,
         CASE WHEN event_type = 'view' THEN NULL ELSE value END AS unit_price,
         CASE user_id % 5 WHEN 0 THEN 'black' WHEN 1 THEN 'red' WHEN 2 THEN 'blue' WHEN 3 THEN 'green'
                          ELSE 'white' END AS color,
         ts
  FROM events)
"""


def product_log(t: Tables) -> DataFrame:
    e = t.events
    k = F.get_json_object("props", "$.k").cast("long")
    et = F.col("event_type")
    return e.select(
        F.col("event_id").alias("id"), F.col("user_id").alias("product_id"),
        F.when(et == "purchase", "sale").when(et == "signup", "insert").when(et == "view", "restock")
        .otherwise("price_update").alias("action"),
        F.when(et == "purchase", -(k % 5 + 1)).when(et == "signup", 10 + k % 7).when(et == "view", k % 4 + 1)
        .otherwise(F.lit(0)).cast("long").alias("qty_delta"),
        F.when(et == "view", F.lit(None)).otherwise(F.col("value")).alias("unit_price"),
        F.element_at(F.array(*[F.lit(c) for c in ("black", "red", "blue", "green", "white")]),
                     (F.col("user_id") % 5 + 1).cast("int")).alias("color"),
        "ts",
    )


# (y_true, score) pairs: labels joined to documents, score = n_chars / max(n_chars) over the joined rows.
SCORED_SQL = """
scored AS (
  SELECT l.doc_id, l.toxic AS y_true, CAST(d.n_chars AS DOUBLE) / (SELECT max(d2.n_chars) FROM documents d2
         JOIN labels l2 ON d2.doc_id = l2.doc_id) AS score
  FROM labels l JOIN documents d ON l.doc_id = d.doc_id)
"""


def scored(t: Tables) -> DataFrame:
    j = t.labels.join(t.documents.select("doc_id", "n_chars"), "doc_id")
    mx = j.agg(F.max("n_chars")).first()[0]
    return j.select("doc_id", F.col("toxic").alias("y_true"), (F.col("n_chars").cast("double") / F.lit(float(mx))).alias("score"))


# Daily series per event_type: actual = daily mean of value, predicted = mean of the 7 previous days' actuals.
DAILY_SQL = """
daily AS (
  SELECT event_type AS series, CAST(ts AS DATE) AS day, avg(value) AS actual FROM events GROUP BY ALL)
"""


def daily(t: Tables) -> DataFrame:
    return t.events.groupBy(F.col("event_type").alias("series"), F.to_date("ts").alias("day")).agg(
        F.avg("value").alias("actual"))
