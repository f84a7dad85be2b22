"""Graph queries (O1-O8) on orders/customer/lineitem."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.operators import graph as G
from tessera.operators.joins import enrich
from tessera.plans.registry import query
from tessera.session import Tables

REL_COLS = ["o_custkey", "o_orderpriority", "c_nationkey", "c_mktsegment"]


def order_edges(spark, sf_dir):
    t = Tables(spark, sf_dir)
    tx = enrich(t.orders.select("o_orderkey", "o_custkey", "o_orderpriority"),
                t.customer.select(F.col("c_custkey").alias("o_custkey"), "c_nationkey", "c_mktsegment"),
                "o_custkey")
    return G.relation_edges(tx, "o_orderkey", REL_COLS)


_EDGES_SQL = """
WITH tx AS (
  SELECT o.o_orderkey, o.o_custkey, o.o_orderpriority, c.c_nationkey, c.c_mktsegment
  FROM orders o LEFT JOIN customer c ON o.o_custkey = c.c_custkey),
e AS (
  SELECT o_orderkey AS node, 'o_custkey' AS relation, CAST(o_custkey AS VARCHAR) AS entity FROM tx WHERE o_custkey IS NOT NULL
  UNION ALL SELECT o_orderkey, 'o_orderpriority', CAST(o_orderpriority AS VARCHAR) FROM tx WHERE o_orderpriority IS NOT NULL
  UNION ALL SELECT o_orderkey, 'c_nationkey', CAST(c_nationkey AS VARCHAR) FROM tx WHERE c_nationkey IS NOT NULL
  UNION ALL SELECT o_orderkey, 'c_mktsegment', CAST(c_mktsegment AS VARCHAR) FROM tx WHERE c_mktsegment IS NOT NULL)
"""


@query("relation_graph_hubs", _EDGES_SQL + """
SELECT relation, entity, count(*) AS degree, CAST(count(*) * (count(*) - 1) / 2 AS BIGINT) AS n_pairs
FROM e GROUP BY relation, entity ORDER BY degree DESC, relation, entity LIMIT 10
""")
def relation_graph_hubs(spark, sf_dir):
    """Flagship: orders LEFT JOIN customer -> typed edges -> top-10 hub entities."""
    return G.top_hubs(order_edges(spark, sf_dir), 10)


@query("o1_relation_edges", _EDGES_SQL + "SELECT node, relation, entity FROM e")
def o1_relation_edges(spark, sf_dir):
    return order_edges(spark, sf_dir)


@query("o3_pair_stats", _EDGES_SQL + """
, d AS (SELECT relation, entity, count(*) AS degree FROM e GROUP BY relation, entity)
SELECT relation, count(*) AS n_entities, CAST(sum(degree) AS BIGINT) AS n_edges, max(degree) AS max_degree,
       CAST(sum(CAST(degree * (degree - 1) / 2 AS BIGINT)) AS BIGINT) AS n_pairs
FROM d GROUP BY relation
""")
def o3_pair_stats(spark, sf_dir):
    return G.pair_stats(order_edges(spark, sf_dir))


@query("o3_copurchase_pair_stats", """
WITH d AS (SELECT l_orderkey, count(DISTINCT l_partkey) AS degree FROM lineitem GROUP BY l_orderkey)
SELECT 'l_orderkey' AS relation, count(*) AS n_entities, CAST(sum(degree) AS BIGINT) AS n_edges,
       max(degree) AS max_degree, CAST(sum(CAST(degree * (degree - 1) / 2 AS BIGINT)) AS BIGINT) AS n_pairs
FROM d
""")
def o3_copurchase_pair_stats(spark, sf_dir):
    """Parts bought in one order: projection size of the part-part co-purchase graph."""
    t = Tables(spark, sf_dir)
    edges = G.relation_edges(
        t.lineitem.select(F.col("l_partkey"), F.col("l_orderkey")).distinct(), "l_partkey", ["l_orderkey"]
    )
    return G.pair_stats(edges)


@query("o2_index_nodes", """
WITH n AS (
  SELECT DISTINCT 'customer' AS node_type, o_custkey AS node_id FROM orders WHERE o_custkey IS NOT NULL
  UNION SELECT DISTINCT 'order', o_orderkey FROM orders WHERE o_orderkey IS NOT NULL)
SELECT node_type, node_id, CAST(row_number() OVER (PARTITION BY node_type ORDER BY node_id) - 1 AS BIGINT) AS idx FROM n
""")
def o2_index_nodes(spark, sf_dir):
    t = Tables(spark, sf_dir)
    nodes = (t.orders.select(F.lit("customer").alias("node_type"), F.col("o_custkey").alias("node_id"))
             .unionByName(t.orders.select(F.lit("order").alias("node_type"), F.col("o_orderkey").alias("node_id"))))
    return G.index_nodes(nodes)


def _typed_edges(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return t.orders.where(F.col("o_custkey").isNotNull()).select(
        F.lit("target").alias("src_type"), F.lit("relation0").alias("relation"), F.lit("customer").alias("dst_type"),
        F.col("o_orderkey").alias("src"), F.col("o_custkey").alias("dst"))


@query("o4_heterograph", """
WITH e AS (SELECT 'target' AS src_type, 'relation0' AS relation, 'customer' AS dst_type, o_orderkey AS src, o_custkey AS dst
           FROM orders WHERE o_custkey IS NOT NULL)
SELECT * FROM e
UNION ALL SELECT dst_type, 'reverse_' || relation, src_type, dst, src FROM e
UNION ALL SELECT 'target', 'self_relation', 'target', n, n FROM (SELECT DISTINCT src AS n FROM e)
""")
def o4_heterograph(spark, sf_dir):
    return G.build_heterograph(_typed_edges(spark, sf_dir))


@query("o5_graph_stats", """
WITH e AS (SELECT 'target' AS src_type, 'relation0' AS relation, 'customer' AS dst_type, o_orderkey AS src, o_custkey AS dst
           FROM orders WHERE o_custkey IS NOT NULL),
g AS (SELECT * FROM e
  UNION ALL SELECT dst_type, 'reverse_' || relation, src_type, dst, src FROM e
  UNION ALL SELECT 'target', 'self_relation', 'target', n, n FROM (SELECT DISTINCT src AS n FROM e))
SELECT src_type, relation, dst_type, count(*) AS n_edges, count(DISTINCT src) AS n_src, count(DISTINCT dst) AS n_dst
FROM g GROUP BY ALL
""")
def o5_graph_stats(spark, sf_dir):
    return G.graph_stats(G.build_heterograph(_typed_edges(spark, sf_dir)))


@query("o6_node_features", """
WITH idx AS (SELECT node_id, row_number() OVER (ORDER BY node_id) - 1 AS idx
             FROM (SELECT DISTINCT o_custkey AS node_id FROM orders WHERE o_custkey IS NOT NULL)),
f AS (SELECT c_custkey AS node_id, c_acctbal FROM customer),
j AS (SELECT f.node_id, f.c_acctbal, idx.idx FROM f LEFT JOIN idx USING (node_id)),
m AS (SELECT node_id, (SELECT max(idx) FROM idx) + row_number() OVER (ORDER BY node_id) AS new_idx FROM j WHERE idx IS NULL)
SELECT j.node_id, j.c_acctbal, CAST(coalesce(j.idx, m.new_idx) AS BIGINT) AS idx FROM j LEFT JOIN m USING (node_id)
""")
def o6_node_features(spark, sf_dir):
    t = Tables(spark, sf_dir)
    index = G.index_nodes(t.orders.select(F.lit("customer").alias("node_type"), F.col("o_custkey").alias("node_id")))
    feats = t.customer.select(F.col("c_custkey").alias("node_id"), "c_acctbal")
    return G.node_features(index, feats)


@query("o7_sample_neighbors_full", """
WITH e AS (SELECT DISTINCT l_partkey AS src, l_suppkey AS dst FROM lineitem),
s AS (SELECT s_suppkey AS node FROM supplier WHERE s_nationkey = 3),
h1 AS (SELECT 1 AS hop, e.src, e.dst FROM e JOIN s ON e.dst = s.node)
SELECT hop, src, dst FROM h1
""")
def o7_sample_neighbors_full(spark, sf_dir):
    """Suppliers of one nation as seeds, all in-neighbours (parts) at hop 1."""
    t = Tables(spark, sf_dir)
    edges = t.lineitem.select(F.col("l_partkey").alias("src"), F.col("l_suppkey").alias("dst")).distinct()
    seeds = t.supplier.where(F.col("s_nationkey") == 3).select(F.col("s_suppkey").alias("node"))
    return G.sample_neighbors(edges, seeds, hops=1, fanout=None)


@query("o7_sample_neighbors_fanout")
def o7_sample_neighbors_fanout(spark, sf_dir):
    """Two hops, at most 5 sampled in-edges per frontier node."""
    t = Tables(spark, sf_dir)
    edges = t.lineitem.select(F.col("l_partkey").alias("src"), F.col("l_suppkey").alias("dst")).distinct()
    edges = edges.unionByName(edges.select(F.col("dst").alias("src"), F.col("src").alias("dst")))
    seeds = t.supplier.where(F.col("s_nationkey") == 3).select(F.col("s_suppkey").alias("node"))
    return G.sample_neighbors(edges, seeds, hops=2, fanout=5, seed=7)


@query("o8_neighbor_mean", """
WITH e AS (SELECT DISTINCT o_custkey AS src, o_orderkey AS dst FROM orders WHERE o_custkey IS NOT NULL),
f AS (SELECT c_custkey AS node, c_acctbal AS f0, CAST(c_nationkey AS DOUBLE) AS f1 FROM customer)
SELECT e.dst AS node, round(avg(f.f0), 6) AS f0, round(avg(f.f1), 6) AS f1
FROM e JOIN f ON e.src = f.node GROUP BY e.dst
""")
def o8_neighbor_mean(spark, sf_dir):
    """Each order averages its customer's feature vector (acctbal, nationkey)."""
    t = Tables(spark, sf_dir)
    edges = t.orders.where(F.col("o_custkey").isNotNull()).select(
        F.col("o_custkey").alias("src"), F.col("o_orderkey").alias("dst")).distinct()
    feats = t.customer.select(F.col("c_custkey").alias("node"),
                              F.array(F.col("c_acctbal"), F.col("c_nationkey").cast("double")).alias("features"))
    out = G.neighbor_mean(edges, feats)
    return out.select("node", F.round(out.features[0], 6).alias("f0"), F.round(out.features[1], 6).alias("f1"))


@query("o8_neighbor_sym", """
WITH e AS (SELECT DISTINCT l_suppkey AS src, l_partkey AS dst FROM lineitem WHERE l_suppkey IS NOT NULL AND l_partkey IS NOT NULL),
a AS (SELECT src, count(*) AS dout FROM e GROUP BY src), b AS (SELECT dst, count(*) AS din FROM e GROUP BY dst)
SELECT dst AS node, round(sum(s_acctbal / sqrt(dout) / sqrt(din)), 6) AS f0, round(sum(s_nationkey / sqrt(dout) / sqrt(din)), 6) AS f1
FROM e JOIN a USING (src) JOIN b USING (dst) JOIN supplier ON s_suppkey = src GROUP BY dst
""")
def o8_neighbor_sym(spark, sf_dir):
    """Each part sums its suppliers' feature vectors (acctbal, nationkey) with the symmetric degree norm."""
    t = Tables(spark, sf_dir)
    edges = t.lineitem.where("l_suppkey IS NOT NULL AND l_partkey IS NOT NULL").select(
        F.col("l_suppkey").alias("src"), F.col("l_partkey").alias("dst")).distinct()
    feats = t.supplier.select(F.col("s_suppkey").alias("node"), F.array(F.col("s_acctbal"), F.col("s_nationkey").cast("double")).alias("features"))
    out = G.neighbor_mean(edges, feats, norm="sym")
    return out.select("node", F.round(out.features[0], 6).alias("f0"), F.round(out.features[1], 6).alias("f1"))
