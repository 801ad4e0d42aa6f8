"""Running totals and row numbers over a global order, without a one-partition window.

Rows are range-partitioned by the order, each partition accumulates its own total, and the
totals of earlier partitions (one row per partition) are added on top.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docloom.staging import stage


def running_total(
    df: DataFrame, order_by: Sequence[Column], value: Column, out: str, partitions: int | None = None
) -> DataFrame:
    """Add ``out``: the sum of ``value`` (whole numbers) over all rows up to and including this one.

    The order should be close to unique: equal rows share a range partition, so pre-aggregate copies.
    """
    spark = df.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    keep = df.columns
    placed = (
        df.withColumn("_value", value.cast("bigint"))
        .repartitionByRange(n, *order_by)
        .sortWithinPartitions(*order_by)
    )
    schema = T.StructType(
        list(placed.schema) + [T.StructField("_part", T.IntegerType()), T.StructField("_local", T.LongType())]
    )

    def accumulate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        carried = 0
        for batch in batches:
            values = batch.column(batch.num_columns - 1).to_numpy(zero_copy_only=False)
            local = np.cumsum(values, dtype=np.int64) + carried
            if len(local):
                carried = int(local[-1])
            arrays = [*batch.columns, pa.array(np.full(len(local), part, dtype=np.int32)), pa.array(local)]
            yield pa.RecordBatch.from_arrays(arrays, names=[*batch.schema.names, "_part", "_local"])

    # Staged, because both reads below must see the same partition numbers.
    staged = stage(placed.mapInArrow(accumulate, schema), "running-total")
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        staged.groupBy("_part")
        .agg(F.sum("_value").alias("_total"))
        .select("_part", F.coalesce(F.sum("_total").over(before), F.lit(0)).alias("_offset"))
    )
    # One row per range partition, at most n of them: safe to broadcast.
    return staged.join(F.broadcast(offsets), "_part").select(
        *keep, (F.col("_local") + F.col("_offset")).alias(out)
    )


def numbered(df: DataFrame, order_by: Sequence[Column], out: str, partitions: int | None = None) -> DataFrame:
    """Add ``out``: 1, 2, 3 ... in the given order."""
    return running_total(df, order_by, F.lit(1), out, partitions)


def surrogate_keys(
    new: DataFrame, existing: DataFrame, id_column: str, order_by: Sequence[Column]
) -> DataFrame:
    """Give the new rows ids that follow the largest existing one."""
    last = existing.agg(F.coalesce(F.max(id_column), F.lit(0)).alias("last"))
    ids = numbered(new, order_by, "_n")
    return ids.withColumn(id_column, last.scalar() + F.col("_n")).drop("_n")


PAGE_BITS = 20


def chunk_key(metadata_id: Column, page_number: Column) -> Column:
    """Chunk id from document id and page: unique, and the same whenever the page is chunked again.

    A text cell holds at most 2 GB, so page numbers stay far below 2**20; anything else is an error.
    """
    fits = (page_number >= 0) & (page_number < (1 << PAGE_BITS)) & (metadata_id >= 0)
    key = F.shiftleft(metadata_id.cast("bigint"), PAGE_BITS) + page_number
    return F.when(fits, key).otherwise(F.raise_error(F.lit("page number or document id out of range")).cast("bigint"))


def id_slices(ids: DataFrame, column: str, size: int) -> DataFrame:
    """Ids in groups of ``size``: one row per slice with its id list, as an export request takes it."""
    placed = numbered(ids.select(column).distinct(), [F.col(column)], "_n")
    slice_no = F.floor((F.col("_n") - 1) / size).cast("bigint")
    return (
        placed.groupBy(slice_no.alias("slice_no"))
        .agg(F.array_sort(F.collect_list(column)).alias("ids"))
    )


def weighted_batches(df: DataFrame, order_by: Sequence[Column], weight: Column, target: int, out: str = "batch_no") -> DataFrame:
    """Add the batch of each row: neighbours in the order, cut wherever the running weight passes a multiple of ``target``.

    A batch weighs at most ``target`` plus its last row. NULL and negative weights count as 0.
    """
    if target < 1:
        raise ValueError("target must be at least 1")
    weight = F.greatest(F.coalesce(weight.cast("bigint"), F.lit(0)), F.lit(0))
    placed = running_total(df.withColumn("_weight", weight), order_by, F.col("_weight"), "_through")
    return placed.withColumn(out, F.expr(f"(_through - _weight) DIV {target}")).drop("_weight", "_through")


def spread_by_weight(df: DataFrame, order_by: Sequence[Column], weight: Column, target: int) -> DataFrame:
    """``df`` with one task per weighted batch, before slow work whose time follows the weight."""
    placed = stage(weighted_batches(df, order_by, weight, target, "_batch"), "weighted")
    tasks = (placed.agg(F.max("_batch")).first()[0] or 0) + 1
    return placed.repartitionById(tasks, F.col("_batch").cast("int")).drop("_batch")
