"""Global row numbering without a single-partition window.

``Window.orderBy`` without ``partitionBy`` moves every row into one task; that
is never used in this package.  Instead the rows are range-partitioned on the
(unique) sort key, numbered inside each partition, and shifted by the row
counts of the preceding partitions.  Only the per-partition counts (one row
per partition) reach the driver.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.session import cut_lineage

_LOW_BITS = 33  # monotonically_increasing_id = partition index << 33 | row index in partition


def global_row_number(df: DataFrame, order_cols: list, out_col: str = "row_number",
                      num_partitions: int | None = None) -> DataFrame:
    """Add a 1-based dense position following ``order_cols`` (which must be unique).

    The ranged data is checkpointed to the shared checkpoint folder so the
    partition layout seen by the count job and by the final job is the same
    (range bounds are sampled per execution) and a lost executor does not
    invalidate the numbering.
    """
    spark = df.sparkSession
    n = num_partitions or max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    ranged = (
        df.repartitionByRange(n, *order_cols)
        .sortWithinPartitions(*order_cols)
        .withColumn("_pid", F.spark_partition_id())
        .withColumn("_mid", F.monotonically_increasing_id())
    )
    ranged = cut_lineage(ranged)
    counts = sorted((r["_pid"], r["count"]) for r in ranged.groupBy("_pid").count().collect())
    offsets, acc = [], 0
    for pid, cnt in counts:
        offsets.append((pid, acc))
        acc += cnt
    off_df = spark.createDataFrame(offsets or [(0, 0)], "_pid int, _offset long")
    local = F.col("_mid") - F.shiftleft(F.col("_pid").cast("long"), _LOW_BITS)
    return (
        ranged.join(F.broadcast(off_df), "_pid")  # one row per partition: bounded by n
        .withColumn(out_col, F.col("_offset") + local + 1)
        .drop("_pid", "_mid", "_offset")
    )


def row_position(df: DataFrame, out_col: str = "pos") -> DataFrame:
    """0-based position of each row: file order for a file scan (path, then place in the file).

    A scan packs splits of several files into its partitions in no fixed order,
    so file-backed rows are numbered by their file path, block start and order
    within the block.  Other inputs (a checkpoint, a range, a local table) keep
    their partition order; they are checkpointed first, so the count and the
    result see one layout.
    """
    spark = df.sparkSession
    if df.inputFiles():
        placed = df.withColumns({"_path": F.input_file_name(), "_block": F.input_file_block_start(),
                                 "_mid": F.monotonically_increasing_id()})
        placed = cut_lineage(placed)  # the places are read once, in the scan itself
        numbered = global_row_number(placed, ["_path", "_block", "_mid"], out_col)
        return numbered.withColumn(out_col, F.col(out_col) - 1).drop("_path", "_block", "_mid")
    df = cut_lineage(df)
    tagged = df.withColumn("_pid", F.spark_partition_id()).withColumn("_mid", F.monotonically_increasing_id())
    counts = sorted((r["_pid"], r["count"]) for r in tagged.groupBy("_pid").count().collect())
    offsets, acc = [], 0
    for pid, cnt in counts:
        offsets.append((pid, acc))
        acc += cnt
    off_df = spark.createDataFrame(offsets or [(0, 0)], "_pid int, _offset long")
    local = F.col("_mid") - F.shiftleft(F.col("_pid").cast("long"), _LOW_BITS)
    return (
        tagged.join(F.broadcast(off_df), "_pid")  # one row per input partition
        .withColumn(out_col, F.col("_offset") + local)
        .drop("_pid", "_mid", "_offset")
    )


def global_cumsum(df: DataFrame, order_cols: list, sum_cols: list[str], suffix: str = "_cum",
                  num_partitions: int | None = None) -> DataFrame:
    """Inclusive running sums of ``sum_cols`` (as doubles, null as 0) along a global order (``order_cols`` unique).

    Range partitioning keeps partitions balanced; the sorted partitions are
    checkpointed and summed where they lie, each starting from the totals of the
    partitions before it (one row per partition reaches the driver).
    """
    spark = df.sparkSession
    n = num_partitions or max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    ranged = cut_lineage(df.repartitionByRange(n, *order_cols).sortWithinPartitions(*order_cols))
    totals = ranged.groupBy(F.spark_partition_id().alias("_pid")).agg(*[F.sum(c).alias(c) for c in sum_cols]).collect()
    starts, acc = {}, [0.0] * len(sum_cols)
    for r in sorted(totals, key=lambda r: r["_pid"]):
        starts[r["_pid"]] = acc
        acc = [a + float(r[c] or 0) for a, c in zip(acc, sum_cols, strict=True)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        state = list(starts.get(TaskContext.get().partitionId(), [0.0] * len(sum_cols)))
        for batch in batches:
            cols = list(batch.columns)
            for k, c in enumerate(sum_cols):
                values = batch.column(batch.schema.get_field_index(c)).cast(pa.float64()).fill_null(0.0)
                upto = np.cumsum(values.to_numpy(zero_copy_only=False)) + state[k]
                cols.append(pa.array(upto, pa.float64()))
                state[k] = float(upto[-1]) if len(upto) else state[k]
            yield pa.RecordBatch.from_arrays(cols, names=[*batch.schema.names, *[c + suffix for c in sum_cols]])

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in ranged.schema]
    return ranged.mapInArrow(run, ", ".join([*fields, *[f"`{c}{suffix}` double" for c in sum_cols]]))


def segmented_cumsum(df: DataFrame, segment: str, order_cols: list, col: str, num_partitions: int | None = None) -> DataFrame:
    """Running sums of ``col`` that start anew with every value of ``segment``: ``_upto`` and, without the row itself, ``_before``.

    The rows are range partitioned by the segment and ``order_cols`` (unique within it), so a segment of any size
    spans as many partitions as it needs; a partition's first segment goes on from the partitions before it (one
    row per partition reaches the driver).
    """
    spark = df.sparkSession
    n = num_partitions or max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    ranged = cut_lineage(df.repartitionByRange(n, segment, *order_cols).sortWithinPartitions(segment, *order_cols))
    per = ranged.groupBy(F.spark_partition_id().alias("_pid")).agg(F.min(segment).alias("_first"), F.max(segment).alias("_last"))
    borders = per.collect()
    held = ranged.groupBy(F.spark_partition_id().alias("_pid"), segment).agg(F.sum(col).alias("_sum"))
    edges = spark.createDataFrame([(r["_pid"], r["_last"]) for r in borders] or [(-1, None)], held.select("_pid", segment).schema)
    tails = {r["_pid"]: r["_sum"] for r in held.join(F.broadcast(edges), ["_pid", segment]).collect()}  # the last segment's sum of each partition
    starts: dict[int, float] = {}
    name, carry = None, 0.0
    for r in sorted(borders, key=lambda r: r["_pid"]):
        starts[r["_pid"]] = carry if r["_first"] == name else 0.0
        carry = tails.get(r["_pid"], 0.0) + (starts[r["_pid"]] if r["_first"] == r["_last"] else 0.0)
        name = r["_last"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        total, name, begun = starts.get(TaskContext.get().partitionId(), 0.0), None, False
        for batch in batches:
            if not batch.num_rows:
                continue
            names = batch.column(batch.schema.get_field_index(segment))
            values = batch.column(batch.schema.get_field_index(col)).to_numpy(zero_copy_only=False).astype(float)
            new = np.ones(len(values), bool)
            new[1:] = pc.not_equal(names.slice(1), names.slice(0, len(names) - 1)).to_numpy(zero_copy_only=False)
            new[0] = begun and names[0].as_py() != name
            upto, edges_ = np.empty(len(values)), [0, *np.flatnonzero(new[1:]) + 1, len(values)]
            if new[0]:
                total = 0.0
            for a, b in zip(edges_, edges_[1:]):
                upto[a:b] = np.cumsum(np.concatenate([[total], values[a:b]]))[1:]
                total = 0.0
            total, name, begun = float(upto[-1]), names[-1].as_py(), True
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(upto), pa.array(upto - values)], names=[*batch.schema.names, "_upto", "_before"])

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in ranged.schema]
    return ranged.mapInArrow(run, ", ".join([*fields, "_upto double", "_before double"]))
