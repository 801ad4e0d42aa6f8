"""Order of document versions: ranks, and which version of each number is current."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docloom.staging import stage

NUMBER, MAJOR, MINOR = "document_number", "document_major_version", "document_minor_version"

def _newest_first() -> list[Column]:
    return [F.col(MAJOR).desc_nulls_last(), F.col(MINOR).desc_nulls_last()]


def _changes(columns: list[pa.Array]) -> np.ndarray:
    """For every row but the first: whether it differs from the row before it in any column; NULL equals NULL."""
    out = np.zeros(max(0, len(columns[0]) - 1), dtype=bool)
    for column in columns:
        one, other = column.slice(1), column.slice(0, max(0, len(column) - 1))
        same = pc.or_(pc.fill_null(pc.equal(one, other), False), pc.and_(one.is_null(), other.is_null()))
        out |= ~same.to_numpy(zero_copy_only=False)
    return out


def _starts(new: np.ndarray, first: int, carried: int) -> np.ndarray:
    """Position of the group start of every row of a batch that begins at ``first`` in its partition."""
    return np.maximum.accumulate(np.where(new, np.arange(first, first + len(new)), carried))


def _locate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    part, done, number_at, version_at, last = TaskContext.get().partitionId(), 0, 0, 0, None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(batch.schema.get_field_index(c)) for c in (NUMBER, MAJOR, MINOR)]
        # The last row of the batch before goes in front, so that every row has one to compare with.
        seen = columns if last is None else [pa.concat_arrays([x, c]) for x, c in zip(last, columns, strict=True)]
        new_number = _changes(seen[:1])
        new_version = new_number | _changes(seen[1:])
        if last is None:
            new_number, new_version = np.append(False, new_number), np.append(False, new_version)
        numbers, places = _starts(new_number, done, number_at), _starts(new_version, done, version_at)
        number_at, version_at, last = int(numbers[-1]), int(places[-1]), [c.slice(len(c) - 1) for c in columns]
        done += batch.num_rows
        at = np.arange(done - batch.num_rows, done)
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array(np.full(len(at), part, np.int32)), pa.array(at), pa.array(numbers), pa.array(places)],
            [*batch.schema.names, "_part", "_at", "_number_at", "_version_at"])


def version_rank(df: DataFrame, out: str = "version_rank") -> DataFrame:
    """Add the rank of each row among the versions of its number: 1 is newest, ties share a rank, NULLs last.

    One range partitioning and one staged table. A partition notes where the group of each row starts in it; one row
    per partition then says where the group that reaches over its border started. Equal rows are
    spread by an own order, so one number, or one version, may have any share of the rows.
    """
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = [F.col(NUMBER).asc_nulls_first(), *_newest_first()]
    placed = (df.withColumn("_salt", F.monotonically_increasing_id()).repartitionByRange(n, *order, F.col("_salt"))
              .sortWithinPartitions(*order).drop("_salt"))
    fields = [T.StructField("_part", T.IntegerType()), *[T.StructField(c, T.LongType()) for c in ("_at", "_number_at", "_version_at")]]
    rows = stage(placed.mapInArrow(_locate, T.StructType([*placed.schema, *fields])), "located")
    number, version = F.struct(NUMBER), F.struct(NUMBER, MAJOR, MINOR)
    borders = rows.groupBy("_part").agg(
        F.count(F.lit(1)).alias("n"), F.min_by(version, "_at").alias("head"), F.max_by(version, "_at").alias("tail"),
        F.max("_number_at").alias("number_at"), F.max("_version_at").alias("version_at"))
    # At most one row per range partition goes through these windows and is broadcast.
    walk = Window.orderBy("_part")
    before = walk.rowsBetween(Window.unboundedPreceding, -1)
    borders = borders.select(
        "_part", "number_at", "version_at", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"),
        (~F.col("head").getField(NUMBER).eqNullSafe(F.lag(F.col("tail").getField(NUMBER)).over(walk)) | (F.row_number().over(walk) == 1)).alias("new_number"),
        (~F.col("head").eqNullSafe(F.lag("tail").over(walk))).alias("new_version"))

    def last_start(at: str, new: str) -> Column:
        """Where the last group of a partition starts among all rows; NULL if that was before the partition."""
        return F.when((F.col(at) > 0) | F.col(new), F.col("offset") + F.col(at))

    def head_start(at: str, new: str) -> Column:
        return F.when(F.col(new), F.col("offset")).otherwise(F.max(last_start(at, new)).over(before))

    borders = borders.select("_part", F.col("offset").alias("_offset"), head_start("number_at", "new_number").alias("_number_head"),
                             head_start("version_at", "new_version").alias("_version_head"))

    def start(at: str, head: str) -> Column:
        return F.when(F.col(at) > 0, F.col("_offset") + F.col(at)).otherwise(F.col(head))

    rank = start("_version_at", "_version_head") - start("_number_at", "_number_head") + 1
    return rows.join(F.broadcast(borders), "_part").select(*df.columns, rank.cast("int").alias(out))


def with_latest(df: DataFrame, out: str = "is_latest_doc_in_dl") -> DataFrame:
    """Set ``out`` on every row: true on the newest version of its number (all of them, when tied).

    Needs only the newest version per number, an aggregate that combines before the shuffle.
    """
    # Struct comparison puts NULL below every value, which is where a missing version belongs.
    version = F.struct(MAJOR, MINOR)
    newest = df.groupBy(F.col(NUMBER).alias("_number")).agg(F.max(version).alias("_newest"))
    newest = stage(newest, "newest")
    return (
        df.join(newest, F.col(NUMBER).eqNullSafe(F.col("_number")), "left")
        .withColumn(out, version.eqNullSafe(F.col("_newest")))
        .drop("_number", "_newest")
    )


def superseded(df: DataFrame, id_column: str = "metadata_id") -> DataFrame:
    """Ids of rows with a newer version of the same number."""
    return with_latest(df.select(id_column, NUMBER, MAJOR, MINOR), "_latest").filter(~F.col("_latest")).select(id_column)
