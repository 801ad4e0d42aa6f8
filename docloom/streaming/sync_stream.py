"""Triggered, incremental copy of chunk changes into a search log."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docloom.schemas import COMPLETED


def change_stream(
    spark: SparkSession, path: str, schema: T.StructType, files_per_batch: int | None = None
) -> DataFrame:
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def as_log(changes: DataFrame, columns: Sequence[str], status: str = "embedding_status", change: str = "change_type") -> DataFrame:
    """Changes as rows of a log. Deleted chunks, and chunks that lost their vector, become tombstones (``gone``)."""
    gone = ~F.col(status).eqNullSafe(F.lit(COMPLETED))
    if change in changes.columns:
        gone = gone | F.col(change).eqNullSafe(F.lit("delete"))
    return changes.select(*columns, gone.alias("gone"))


def sync_once(
    changes: DataFrame, output: str, checkpoint: str, columns: Sequence[str], status: str = "embedding_status",
    change: str = "change_type",
) -> None:
    """Take every change not yet taken, then stop. The checkpoint makes reruns add nothing twice.

    Tombstones let readers drop what they had. Stateless per row: it scales with the input; readers collapse
    the log. The folder belongs to the stream: a log that is to be compacted is a ``sync_log.SyncLog``.
    """
    query = (
        as_log(changes, columns, status, change).writeStream.format("parquet")
        .option("checkpointLocation", checkpoint)
        .option("path", output)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
