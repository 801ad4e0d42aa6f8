"""Attempts as data: a ledger of tries per document and stage, requeue with backoff, dead letters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docloom.operators.stages import BY_NAME
from docloom.schemas import FAILED, PENDING, STAGES

DEAD_LETTER = "DEAD_LETTER"
LEDGER = "metadata_id bigint, stage string, attempt int, error string, tried_at timestamp"


def tries(ledger: DataFrame, stage: str) -> DataFrame:
    """metadata_id, attempts, last_tried of every document the stage has tried: one row each."""
    return ledger.filter(F.col("stage") == stage).groupBy("metadata_id").agg(
        F.max("attempt").alias("attempts"), F.max("tried_at").alias("last_tried"))


def next_attempts(ledger: DataFrame, outcome: DataFrame, stage: str, now: Column) -> DataFrame:
    """Ledger rows for the documents of ``outcome`` (metadata_id, error), numbered after their earlier tries.

    ``error`` is NULL for a success. Several rows of one document are one try, with the least error. Append the result.
    """
    tried = outcome.groupBy("metadata_id").agg(F.min("error").alias("error"))
    return tried.join(tries(ledger, stage), "metadata_id", "left").select(
        "metadata_id", F.lit(stage).alias("stage"), (F.coalesce("attempts", F.lit(0)) + 1).cast("int").alias("attempt"),
        "error", now.cast("timestamp").alias("tried_at"))


def requeue_backoff(
    metadata: DataFrame, ledger: DataFrame, stage: str, now: Column, wait_seconds: int = 60, limit: int = 5
) -> DataFrame:
    """``metadata`` where FAILED documents of the stage are PENDING again when due, and DEAD_LETTER after ``limit`` tries.

    The wait is ``wait_seconds`` after the first try and doubles with each further one. A requeued document has its later
    stages PENDING as well. FAILED documents that are in no ledger are due at once; all others stay.
    """
    column = BY_NAME[stage].column
    failed = F.col(column) == FAILED
    # Only failed documents can change, so only their tries are joined.
    counts = tries(ledger, stage).join(metadata.filter(failed).select("metadata_id"), "metadata_id", "left_semi")
    joined = metadata.join(counts.withColumnsRenamed({"attempts": "_attempts", "last_tried": "_last"}), "metadata_id", "left")
    seconds = F.lit(wait_seconds) * F.pow(F.lit(2.0), F.least(F.coalesce("_attempts", F.lit(1)), F.lit(40)) - 1)
    due = F.col("_last").isNull() | (F.unix_micros("_last") + seconds * 1_000_000 <= F.unix_micros(now.cast("timestamp")))
    dead = F.coalesce(failed & (F.col("_attempts") >= limit), F.lit(False))
    again = F.coalesce(failed & due, F.lit(False)) & ~dead
    names = [s.name for s in STAGES]
    later = [s.column for s in STAGES[names.index(stage):] if s.column in metadata.columns]
    moved = {c: F.when(again, PENDING).when(dead & F.lit(c == column), DEAD_LETTER).otherwise(F.col(c)) for c in later}
    return joined.withColumns(moved).select(*metadata.columns)


def funnel_with_attempts(metadata: DataFrame, ledger: DataFrame, stage: str) -> DataFrame:
    """How many documents stand at each status of the stage after how many tries."""
    return metadata.select("metadata_id", F.col(BY_NAME[stage].column).alias("status")).join(
        tries(ledger, stage), "metadata_id", "left").groupBy("status", F.coalesce("attempts", F.lit(0)).cast("int").alias("attempts")).agg(
        F.count(F.lit(1)).alias("documents"))
