"""The document life cycle: gates, status write-back, roll-up, funnel, requeue."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docloom.schemas import COMPLETED, FAILED, PARTIAL, PENDING, STAGE_COLUMNS, STAGES, Stage

BY_NAME = {stage.name: stage for stage in STAGES}


def gate(stage: Stage) -> Column:
    """True for documents the stage should take: its own status PENDING, the previous one done."""
    ready = F.col(stage.column) == PENDING
    if stage.previous is not None:
        ready = ready & F.col(stage.previous).isin(*stage.accepts)
    return ready


def gated(metadata: DataFrame, stage: str, *columns: str) -> DataFrame:
    return metadata.filter(gate(BY_NAME[stage])).select("metadata_id", *columns)


def gate_report(metadata: DataFrame) -> DataFrame:
    """One row per (stage, document) that may run now, from one scan."""
    open_stages = F.array_compact(F.array(*[F.when(gate(s), F.lit(s.name)) for s in STAGES]))
    return metadata.select(F.explode(open_stages).alias("stage"), "metadata_id")


def in_batch(df: DataFrame, batch: DataFrame, key: str = "metadata_id") -> DataFrame:
    """Rows whose key is in ``batch``. A semi-join: the ids never travel through the driver."""
    return df.join(batch.select(key), key, "left_semi")


def status_rollup(chunks: DataFrame, status: str = "embedding_status", out: str = "final_status") -> DataFrame:
    """One status per document: all chunks done, some, or none. NULL counts as not done."""
    done = F.count(F.when(F.col(status) == COMPLETED, F.lit(1)))
    counted = chunks.groupBy("metadata_id").agg(
        done.alias("n_completed"), F.count(F.lit(1)).alias("n_total")
    )
    verdict = (
        F.when(F.col("n_completed") == F.col("n_total"), COMPLETED)
        .when(F.col("n_completed") > 0, PARTIAL)
        .otherwise(FAILED)
    )
    return counted.withColumn(out, verdict)


def distinct_status(df: DataFrame, status: str) -> DataFrame:
    return df.select("metadata_id", status).distinct()


def funnel(metadata: DataFrame, columns: Sequence[str] = STAGE_COLUMNS) -> DataFrame:
    """How many documents stand at each combination of stage statuses."""
    return metadata.groupBy(*columns).agg(F.count(F.lit(1)).alias("documents"))


def carry_status(batch: DataFrame, source: str = "embedding_status", out: str = "index_status") -> DataFrame:
    """The source status under the next stage's name, for the documents of the batch."""
    return batch.select("metadata_id", F.col(source).alias(out))


def requeue(metadata: DataFrame, from_stage: str, when: Column) -> DataFrame:
    """Reset a stage and all later ones to PENDING for rows where ``when`` holds."""
    names = [s.name for s in STAGES]
    later = {s.column for s in STAGES[names.index(from_stage):]}
    return metadata.withColumns({c: F.when(when, PENDING).otherwise(F.col(c)) for c in metadata.columns if c in later})


def any_failed(columns: Sequence[str] = STAGE_COLUMNS) -> Column:
    return ~reduce(and_, [F.coalesce(F.col(c) != FAILED, F.lit(True)) for c in columns])
