"""Entity-relation graphs from tables.

Edges are long tables ``(src, relation, dst)``; node indices are dense
integers per node type.  Nothing here enumerates all pairs inside a group:
the homogeneous projection is reported through its size (``pair_stats``)
and kept in bipartite (star) form, which carries the same connectivity.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.operators.ranking import global_row_number


def relation_edges(df: DataFrame, key: str, cols: list[str]) -> DataFrame:
    """O1: one row ``(node, relation, entity)`` per non-null entity value.

    The identity key itself is not a relation (it would only add self loops).
    Entity values are compared as strings so different id types share one column.
    """
    rel_cols = [c for c in cols if c != key]
    projected = df.select(F.col(key).alias("node"), *[F.col(c).cast("string").alias(c) for c in rel_cols])
    return (
        projected.unpivot("node", rel_cols, "relation", "entity")
        .where(F.col("entity").isNotNull())
    )


def entity_degrees(edges: DataFrame) -> DataFrame:
    """Degree per entity and the number of node pairs the entity would project to.

    This is the pre-check of the homogeneous projection: ``n_pairs = n(n-1)/2``.
    It is a partial (map-side combined) aggregate, so a hub holding a third
    of all rows costs one counter per task, not a hot partition.
    """
    return (
        edges.groupBy("relation", "entity")
        .agg(F.count(F.lit(1)).alias("degree"))
        .withColumn("n_pairs", (F.col("degree") * (F.col("degree") - 1) / 2).cast("long"))
    )


def pair_stats(edges: DataFrame) -> DataFrame:
    """O3 re-aimed: size of the homogeneous projection per relation without building it."""
    deg = entity_degrees(edges)
    return deg.groupBy("relation").agg(
        F.count(F.lit(1)).alias("n_entities"),
        F.sum("degree").alias("n_edges"),
        F.max("degree").alias("max_degree"),
        F.sum("n_pairs").alias("n_pairs"),
    )


def top_hubs(edges: DataFrame, k: int = 10) -> DataFrame:
    """Entities with the largest degree (ties by relation, entity)."""
    return entity_degrees(edges).orderBy(F.desc("degree"), "relation", "entity").limit(k)


def index_nodes(nodes: DataFrame, type_col: str = "node_type", id_col: str = "node_id") -> DataFrame:
    """O2: dense 0-based index per node type, in id order.

    Distinct nodes are numbered globally on ``(type, id)`` (range partitioned,
    no single-task window); the first global position of each type is then
    subtracted (one row per type).
    """
    distinct = nodes.select(type_col, id_col).where(F.col(id_col).isNotNull()).distinct()
    numbered = global_row_number(distinct, [type_col, id_col], "_pos")
    starts = numbered.groupBy(type_col).agg(F.min("_pos").alias("_start"))
    return (
        numbered.join(F.broadcast(starts), type_col)  # one row per node type
        .select(type_col, id_col, (F.col("_pos") - F.col("_start")).alias("idx"))
    )


def build_heterograph(edges: DataFrame, target_type: str = "target") -> DataFrame:
    """Typed edges plus their reverses plus a self loop on every target node.

    ``edges``: ``(src_type, relation, dst_type, src, dst)``.
    """
    cols = ["src_type", "relation", "dst_type", "src", "dst"]
    fwd = edges.select(*cols)
    rev = edges.select(
        F.col("dst_type").alias("src_type"),
        F.concat(F.lit("reverse_"), F.col("relation")).alias("relation"),
        F.col("src_type").alias("dst_type"),
        F.col("dst").alias("src"),
        F.col("src").alias("dst"),
    )
    targets = (
        edges.where(F.col("src_type") == target_type).select(F.col("src").alias("n"))
        .unionByName(edges.where(F.col("dst_type") == target_type).select(F.col("dst").alias("n")))
        .distinct()
    )
    loops = targets.select(
        F.lit(target_type).alias("src_type"), F.lit("self_relation").alias("relation"),
        F.lit(target_type).alias("dst_type"), F.col("n").alias("src"), F.col("n").alias("dst"),
    )
    return fwd.unionByName(rev).unionByName(loops)


def graph_stats(edges: DataFrame) -> DataFrame:
    """Edges and distinct source/destination nodes per relation."""
    return edges.groupBy("src_type", "relation", "dst_type").agg(
        F.count(F.lit(1)).alias("n_edges"),
        F.countDistinct("src").alias("n_src"),
        F.countDistinct("dst").alias("n_dst"),
    )


def node_features(index: DataFrame, feats: DataFrame, id_col: str = "node_id") -> DataFrame:
    """Features aligned to the node index; nodes without edges get fresh ids.

    Fresh ids continue after the largest existing index, in id order.
    """
    max_idx = index.agg(F.max("idx")).first()[0]
    max_idx = -1 if max_idx is None else max_idx
    joined = feats.join(index.select(id_col, "idx"), id_col, "left")
    missing = joined.where(F.col("idx").isNull()).select(id_col)
    fresh = (
        global_row_number(missing, [id_col], "_k")
        .select(id_col, (F.lit(max_idx) + F.col("_k")).alias("_new"))
    )
    return (
        joined.join(fresh, id_col, "left")
        .withColumn("idx", F.coalesce("idx", "_new"))
        .drop("_new")
    )


def sample_neighbors(edges: DataFrame, seeds: DataFrame, hops: int, fanout: int | None,
                     seed: int = 0) -> DataFrame:
    """Multi-hop in-neighbour sampling without replacement.

    ``edges``: ``(src, dst)``; ``seeds``: ``(node)``.  At each hop every frontier
    node keeps at most ``fanout`` in-edges chosen by a keyed hash (all when
    ``fanout`` is None).  ``row_number <= fanout`` lets Spark insert a
    per-partition group limit before the shuffle, so a hub sends at most
    ``fanout`` rows per input partition.
    """
    from pyspark.sql import Window

    frontier = seeds.select(F.col("node")).distinct()
    out = None
    for h in range(1, hops + 1):
        cand = edges.join(frontier.withColumnRenamed("node", "dst"), "dst")
        if fanout is not None:
            w = Window.partitionBy("dst").orderBy(F.xxhash64(F.lit(seed), F.lit(h), "src", "dst"), "src")
            cand = cand.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= fanout).drop("_r")
        layer = cand.select(F.lit(h).alias("hop"), "src", "dst")
        out = layer if out is None else out.unionByName(layer)
        frontier = layer.select(F.col("src").alias("node")).distinct()
    return out


def neighbor_mean(edges: DataFrame, feats: DataFrame, norm: str = "mean") -> DataFrame:
    """Aggregate neighbour feature vectors per destination node.

    ``edges``: ``(src, dst)`` (self loops included by the caller, as in the
    reference); ``feats``: ``(node, features array<double>)``.
    ``norm='mean'`` divides by in-degree; ``norm='sym'`` weights each edge by
    ``deg(src)^-1/2 * deg(dst)^-1/2`` and sums.
    """
    e = edges.select("src", "dst")
    if norm == "sym":
        out_deg = e.groupBy("src").agg(F.count(F.lit(1)).alias("_dout"))
        in_deg = e.groupBy("dst").agg(F.count(F.lit(1)).alias("_din"))
        e = (e.join(out_deg, "src").join(in_deg, "dst")
             .withColumn("_w", F.pow("_dout", -0.5) * F.pow("_din", -0.5)))
    else:
        e = e.withColumn("_w", F.lit(1.0))
    dims = (
        e.join(feats.withColumnRenamed("node", "src"), "src")
        .select("dst", "_w", F.posexplode("features").alias("pos", "v"))
    )
    agg = F.avg(F.col("v") * F.col("_w")) if norm == "mean" else F.sum(F.col("v") * F.col("_w"))
    per_dim = dims.groupBy("dst", "pos").agg(agg.alias("v"))
    return per_dim.groupBy("dst").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("pos", "v"))), lambda s: s["v"]).alias("features")
    ).withColumnRenamed("dst", "node")
