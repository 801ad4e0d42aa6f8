"""A log of chunk changes that is synced by a stream, compacted now and then, and read by many.

The stream owns one folder for ever, with its list of files and its checkpoint; rows carry the number of the generation
they came in with, which is also a folder level. Compaction never writes there: it writes the present state of
everything up to a generation as a base folder of its own, and then one line that names it. Readers take the newest
such line: its base, and of the log only later generations, which prunes the rest before any file is opened.

Sync and compaction are run in turn by one job; readers may read at any time.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docloom.operators.sync import latest_per_chunk
from docloom.streaming.sync_stream import as_log

GENERATION = "_generation"
_LINES = "generation long, base string"


@dataclass(frozen=True)
class SyncLog:
    """The log under ``root``. ``schema``: the columns kept of a change, with ``version`` among them."""

    spark: SparkSession
    root: str
    schema: T.StructType
    version: str = "audit__updated_date"

    @property
    def _full(self) -> T.StructType:
        return T.StructType([*self.schema, T.StructField("gone", T.BooleanType())])

    def _there(self, folder: str) -> bool:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(folder)
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(path)

    def compacted(self) -> tuple[int, str | None]:
        """(generation, base folder) up to which the log is compacted; (0, None) before the first time."""
        folder = f"{self.root}/generations"
        if not self._there(folder):
            return 0, None
        last = self.spark.read.schema(_LINES).json(folder).orderBy(F.desc("generation")).first()
        return (last.generation, last.base) if last else (0, None)

    def sync(self, changes: DataFrame, status: str = "embedding_status", change: str = "change_type") -> None:
        """Take every change not yet taken, then stop. Reruns add nothing twice; a broken run goes on where it was."""
        generation = self.compacted()[0] + 1
        rows = as_log(changes, self.schema.names, status, change).withColumn(GENERATION, F.lit(generation).cast("long"))
        query = (
            rows.writeStream.format("parquet")
            .partitionBy(GENERATION)
            .option("checkpointLocation", f"{self.root}/progress")
            .option("path", f"{self.root}/log")
            .outputMode("append")
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()

    def changes(self) -> DataFrame:
        """All that is not compacted, and the base below it: (columns, gone)."""
        generation, base = self.compacted()
        parts = []
        if base is not None:
            parts.append(self.spark.read.schema(self._full).parquet(base))
        if self._there(f"{self.root}/log/_spark_metadata"):
            whole = T.StructType([*self._full, T.StructField(GENERATION, T.LongType())])
            parts.append(self.spark.read.schema(whole).parquet(f"{self.root}/log").filter(F.col(GENERATION) > generation).drop(GENERATION))
        if not parts:
            return self.spark.createDataFrame([], self._full)
        return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])

    def read(self) -> DataFrame:
        """The present state: the newest row of every chunk that is still there."""
        return latest_per_chunk(self.changes(), self.version)

    def compact(self) -> int:
        """Write the present state as a new base and let readers begin there; returns the generation it covers.

        A run that breaks off before its last line leaves everything as it was. Older bases stay for readers
        that are still on them; ``bases`` lists them for a clean-up.
        """
        generation, base = self.compacted()[0] + 1, f"{self.root}/base/{uuid.uuid4().hex}"
        self.read().withColumn("gone", F.lit(False)).select(*self._full.names).write.parquet(base)
        line = self.spark.createDataFrame([(generation, base)], _LINES)
        line.coalesce(1).write.mode("append").json(f"{self.root}/generations")
        return generation

    def bases(self) -> list[tuple[int, str]]:
        """(generation, base folder) of every compaction, oldest first; all but the last may be deleted once unread."""
        folder = f"{self.root}/generations"
        rows = self.spark.read.schema(_LINES).json(folder).collect() if self._there(folder) else []
        return sorted((r.generation, r.base) for r in rows)
