"""A training-corpus pipeline: toxicity, near duplicates, benchmark leaks, secrets, packing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from docloom.llm import stages
from docloom.staging import stage

STAGES = [
    ("toxicity", stages.drop_toxic),
    ("jaccard_join", stages.drop_near_duplicates),
    ("decontaminate", stages.drop_leaks),
    ("secret_scan", stages.redact_secrets),
    ("best_fit_packing", stages.pack),
]

# A trained network and a packing heuristic are not SQL; tests hold the pipeline against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``, each written and read again before the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, function in STAGES:
        docs = stage(function(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
