"""The operators as stages of a corpus pipeline: (spark, docs, sf_dir) -> documents, or packed pieces at the end.

Every stage keeps the columns of ``docs``, whatever they are, and works on all rows; doc_id and text are needed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom.llm import decontaminate, jaccard_join, packing, secret_scan, toxicity

KEY = "_docloom_key"


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below the threshold; the network learns from those of ``docs`` that have labels."""
    model = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    scored = toxicity.score_documents(docs, model, score=KEY)
    return scored.filter(F.col(KEY) < toxicity.THRESHOLD).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard_join.keep_one(docs)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    leaks = decontaminate.find_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    keys = leaks.select(F.col("text_key").alias(KEY)).distinct()
    return docs.join(keys, decontaminate.text_key() == F.col(KEY), "left_anti")


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets replaced where the ledger has findings; n_chars follows the text if it is there."""
    _, findings = secret_scan.scan(docs)
    found = findings.select(F.col("blob").alias(KEY), F.lit(True).alias(f"{KEY}_found"))
    text = F.when(F.col(f"{KEY}_found"), secret_scan.redact(F.col("text"))).otherwise(F.col("text"))
    out = docs.join(found, secret_scan.address(F.col("text")) == F.col(KEY), "left").withColumn("text", text)
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        out = out.withColumn("n_chars", F.when(F.col(f"{KEY}_found"), F.length("text").cast(kind)).otherwise(F.col("n_chars")))
    return out.select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack_documents(docs)
