"""Materialise a frame once, in storage every executor can reach.

Stages run slow or non-deterministic work (model calls, decoders) exactly once
and cut lineage, so a lost executor re-reads files instead of redoing the work.

An aggregate that is joined back to its own rows is staged too: Spark then knows its size, so it can
broadcast it when it is small, and can split a hot key of the other side when it is not. It does
neither well while the aggregate is still part of the joining stage.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_OPEN: list[list[tuple[str, DataFrame]]] = []
# Rows travel to Python workers 10,000 at a time whatever their length; long texts and sets would make batches of any size.
_INSIDE = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true", "spark.sql.execution.arrow.maxBytesPerBatch": str(4 << 20)}


def scratch_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``; a local one only under ``local[...]``."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="docloom-"))
    return context.getCheckpointDir().rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A path no earlier run has used, so nothing being read is ever overwritten."""
    return f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as Parquet under a fresh scratch path and return a reader over it."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    staged = spark.read.schema(df.schema).parquet(path)
    if _OPEN:
        _OPEN[-1].append((path, staged))
    return staged


@contextmanager
def temporary(spark: SparkSession) -> Iterator[Callable[..., None]]:
    """Frames staged inside go at the end, but for those handed to the function this gives.

    What is handed out of the block must read no other staged frame of it. Blocks may be nested: what an inner
    one keeps lasts as long as the outer one. Inside, Spark drops the shuffle files of a query when the query ends,
    not when the driver collects its garbage, and hands rows to Python workers about 4 MB at a time at most
    (a longer row alone).
    """
    before = {name: spark.conf.get(name, None) for name in _INSIDE}
    for name, value in _INSIDE.items():
        spark.conf.set(name, value)
    made: list[tuple[str, DataFrame]] = []
    kept: list[DataFrame] = []
    _OPEN.append(made)
    try:
        yield lambda *frames: kept.extend(frames)
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)
        _OPEN.pop()
        for path, frame in made:
            if any(frame is k for k in kept):
                if _OPEN:
                    _OPEN[-1].append((path, frame))
            else:
                folder = spark._jvm.org.apache.hadoop.fs.Path(path)
                folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def spread(df: DataFrame, key: str) -> DataFrame:
    """Hash rows over all cores before heavy per-row work, when the scan gives fewer tasks than cores.

    A large table has many more scan tasks than cores and stays as it is, without a shuffle.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= 2 * cores else df.repartition(cores, key)
