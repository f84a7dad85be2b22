"""Helpers shared by the training-data operators: shared scratch tables, components, running totals."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.session import cut_lineage, ensure_checkpoint_dir


#: Rows whose texts are turned into Python objects at a time, whatever the size of the Arrow batch.
SLICE = 256


def slices(batches: Iterator[pa.RecordBatch], rows: int = SLICE) -> Iterator[pa.RecordBatch]:
    """The batches in slices of at most ``rows`` rows (views, no copy)."""
    for batch in batches:
        for k in range(0, batch.num_rows, rows):
            yield batch.slice(k, rows)


class RecentCache(dict):
    """``key -> make(key)`` in two generations of at most ``size`` keys: what is used again outlives the older one."""

    def __init__(self, make, size: int):
        super().__init__()
        self.make, self.size, self.older = make, size, {}

    def __missing__(self, key):
        found = self.older.get(key)
        if found is None:
            found = self.make(key)
        if len(self) >= self.size:
            self.older = dict(self)
            self.clear()
        self[key] = found
        return found


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new folder in the shared checkpoint folder; Hadoop removes it when the application ends."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    fs = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.mkdirs(where)
    fs.deleteOnExit(where)
    return path


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet to the shared scratch folder and read back.

    Cuts the lineage: a lost executor costs a re-read, not a recomputation, and
    several consumers share one computation.
    """
    path = f"{scratch_path(df.sparkSession, name)}/table"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def connected_components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``(node, root)`` for every node of the undirected ``links``; ``root`` is the smallest node reachable.

    Every round each node hooks to the smallest label among itself and its
    neighbours, the hook is applied to the node's old label too, and labels are
    shortcut by one pointer jump; the rounds end when no label changes.  Labels
    are reduced by map-side combined minima, so a hub costs one row per task.
    Each round is cut by a reliable checkpoint.  Labels are never broadcast: a round's tables grow with the nodes, and
    their Parquet files are far smaller than their rows in the driver.
    """
    # Both directions; loops and doubled links go.
    both = links.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u <> v")
    both = written(both.union(both.select(F.col("v").alias("u"), F.col("u").alias("v"))).distinct(), "links")
    labels = written(both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("label")), "labels")
    while True:
        l1 = labels.select(F.col("u").alias("v"), F.col("label").alias("other"))
        seen = both.join(l1.hint("merge"), "v").groupBy("u").agg(F.min("other").alias("low"))
        low = labels.join(seen.hint("merge"), "u").select("u", "label", F.least("label", "low").alias("low"))
        hooks = low.groupBy(F.col("label").alias("u")).agg(F.min("low").alias("hook"))
        merged = low.join(hooks.hint("merge"), "u", "left").select("u", "label", F.least("low", F.coalesce("hook", "low")).alias("new"))
        jump = merged.select(F.col("u").alias("new"), F.col("new").alias("next"))
        stepped = merged.join(jump.hint("merge"), "new").select("u", F.least("new", "next").alias("label"), (F.col("label") != F.least("new", "next")).alias("moved"))
        stepped = written(stepped, "labels")
        labels = stepped.select("u", "label")
        if not stepped.where("moved").limit(1).count():
            return labels.select(F.col("u").alias("node"), F.col("label").alias("root"))


def ranged(df: DataFrame, order: list[str], partitions: int | None = None) -> DataFrame:
    """``df`` range partitioned and sorted by ``order``, checkpointed so that its partitions stay as they are.

    Rows that tie on every order column may lie in either neighbour partition
    only if they are wholly equal in these columns.
    """
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return cut_lineage(df.repartitionByRange(n, *order).sortWithinPartitions(*order))


def running_totals(df: DataFrame, totals: dict[str, str], pid: str = "_pid") -> DataFrame:
    """Exclusive running sums over a :func:`ranged` table, in partition order.

    ``totals`` maps an output column to a long column, or to ``"1"`` for the
    row count.  The partition sums (one row per partition) are gathered first;
    the rows are then read once more, partition by partition, without a shuffle.
    """
    sums = [F.sum(F.lit(1) if c == "1" else F.col(c)).alias(o) for o, c in totals.items()]
    parts = {r[0]: r[1:] for r in df.groupBy(F.spark_partition_id().alias("p")).agg(*sums).collect()}
    offsets, carry = {}, [0] * len(totals)
    for p in sorted(parts):
        offsets[p] = list(carry)
        carry = [x + (y or 0) for x, y in zip(carry, parts[p], strict=True)]
    fields = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema), *(f"`{o}` long" for o in totals)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np
        from pyspark import TaskContext

        state = list(offsets.get(TaskContext.get().partitionId(), [0] * len(totals)))
        for batch in batches:
            cols = list(batch.columns)
            for k, c in enumerate(totals.values()):
                step = (
                    np.ones(batch.num_rows, np.int64)
                    if c == "1"
                    else batch.column(batch.schema.get_field_index(c)).to_numpy(zero_copy_only=False).astype(np.int64)
                )
                upto = np.cumsum(step)
                cols.append(pa.array(upto - step + state[k], pa.int64()))
                state[k] += int(upto[-1]) if len(upto) else 0
            yield pa.RecordBatch.from_arrays(cols, names=[*batch.schema.names, *totals])

    return df.mapInArrow(run, fields)
