"""Attempts, weighted batches, landing that resumes, and ranks over partition borders."""

import os
import random

from conftest import rows
from docloom.operators import attempts, positions, versions
from docloom.plans import jobs
from docloom.schemas import METADATA
from docloom.sources import writers
from pyspark.sql import functions as F
from test_versions import SCHEMA, expected

NOW = "2024-05-01 00:00:00"


def test_batches_weigh_at_most_the_target_plus_one_row(spark):
    rng = random.Random(3)
    data = [(i, rng.choice([0, 1, 7, 40, 900, None, -5])) for i in range(400)]
    df = spark.createDataFrame(data, "id bigint, w bigint")
    out = positions.weighted_batches(df, [F.col("id")], F.col("w"), 100).collect()
    weighed, want = 0, {}
    for i, w in data:
        want[i] = weighed // 100
        weighed += max(0, w or 0)
    assert {r.id: r.batch_no for r in out} == want
    groups = {}
    for r in out:
        groups.setdefault(r.batch_no, []).append(max(0, r.w or 0))
    assert all(sum(g) <= 100 + max(g) for g in groups.values())


def test_long_documents_are_spread_over_tasks(spark):
    df = spark.createDataFrame([(i, 1000 if i < 8 else 1) for i in range(200)], "id bigint, w bigint").coalesce(1)
    dealt = positions.spread_by_weight(df, [F.col("id")], F.col("w"), 1000)
    most = dealt.withColumn("part", F.spark_partition_id()).groupBy("part").agg(F.sum("w").alias("w")).agg(F.max("w")).first()[0]
    assert most <= 2000 and dealt.count() == 200
    assert positions.spread_by_weight(df.filter("id < 0"), [F.col("id")], F.col("w"), 10).count() == 0


def test_ranks_do_not_depend_on_partition_borders(spark):
    rng = random.Random(5)
    data = [(i, rng.choice(["HOT", "HOT", "HOT", "B", "C", None]), rng.choice([1, 1, 1, 2, None]), rng.choice([0, 0, None, 3])) for i in range(900)]
    data += [(1000 + i, "ONE", 1, 1) for i in range(300)]
    df = spark.createDataFrame(data, SCHEMA).withColumn("_at", F.lit("own column"))
    for partitions in ("1", "3", "40"):
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
        try:
            out = versions.version_rank(df.withColumnRenamed("_at", "at"))
            assert rows(out, "metadata_id", "version_rank") == expected(data)
            assert out.columns == ["metadata_id", "document_number", "document_major_version", "document_minor_version", "at", "version_rank"]
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert versions.version_rank(df.drop("_at").filter("metadata_id < 0")).count() == 0


PATHS = "metadata_id bigint, document_s3_path string"


def test_landing_fetches_missing_and_differing_objects_only(spark, tmp_path):
    calls, manifest = str(tmp_path / "calls"), str(tmp_path / "manifest")
    os.makedirs(calls)
    df = spark.createDataFrame([(i, f"{tmp_path}/out/{i}.bin") for i in range(6)], PATHS)

    def fetch(frame):
        for row in frame.itertuples():
            open(f"{calls}/{row.metadata_id}", "a").write("x")
            if row.metadata_id == 5 and os.path.getsize(f"{calls}/5") < 3:
                raise OSError("later")
            yield "application/octet-stream", b"y" * (row.metadata_id + 1)

    def run(**options):
        landed = writers.land_missing(df, fetch, manifest, **options)
        return rows(landed.filter("fetched"), "metadata_id", "status"), landed.filter("status = 'COMPLETED'").count()

    first, done = run()
    assert [i for i, _ in first] == list(range(6)) and done == 5 + (first[5][1] == "COMPLETED")
    while run()[1] < 6:
        pass
    before = {n: os.path.getsize(f"{calls}/{n}") for n in os.listdir(calls)}
    assert run() == ([], 6) and before == {n: os.path.getsize(f"{calls}/{n}") for n in os.listdir(calls)}
    os.remove(tmp_path / "out" / "2.bin")
    (tmp_path / "out" / "3.bin").write_bytes(b"longer than it was")
    (tmp_path / "out" / "4.bin").write_bytes(b"zzzzz")
    assert run() == ([(2, "COMPLETED"), (3, "COMPLETED")], 6)
    assert run(verify=True) == ([(4, "COMPLETED")], 6) and (tmp_path / "out" / "4.bin").read_bytes() == b"yyyyy"
    assert writers.land_missing(df.filter("metadata_id < 0"), fetch, manifest).count() == 0


def test_attempts_wait_longer_each_time_and_end_as_dead_letters(spark):
    meta = spark.createDataFrame(
        [(1, "FAILED", "FAILED"), (2, "FAILED", "PENDING"), (3, "FAILED", "PENDING"), (4, "COMPLETED", "FAILED"), (5, "FAILED", "PENDING"), (6, None, None)],
        "metadata_id bigint, embedding_status string, index_status string")
    ledger = spark.createDataFrame([], attempts.LEDGER)
    for day in ("2024-04-30 23:00:00", "2024-04-30 23:30:00", "2024-04-30 23:58:00"):
        outcome = spark.createDataFrame([(2, "busy"), (2, "busy again"), (4, None)], "metadata_id bigint, error string")
        if day > "2024-04-30 23:10:00":
            outcome = outcome.union(spark.createDataFrame([(3, "x")], outcome.schema))
        if day > "2024-04-30 23:50:00":
            outcome = outcome.union(spark.createDataFrame([(5, "x")], outcome.schema))
        ledger = ledger.unionByName(attempts.next_attempts(ledger, outcome, "embedding", F.lit(day)))
    assert rows(ledger, "metadata_id", "attempt", "error") == [
        (2, 1, "busy"), (2, 2, "busy"), (2, 3, "busy"), (3, 1, "x"), (3, 2, "x"), (4, 1, None), (4, 2, None), (4, 3, None), (5, 1, "x")]
    out = attempts.requeue_backoff(meta, ledger, "embedding", F.lit(NOW), wait_seconds=60, limit=3).collect()
    assert sorted(map(tuple, out))[:5] == [
        (1, "PENDING", "PENDING"), (2, "DEAD_LETTER", "PENDING"), (3, "PENDING", "PENDING"), (4, "COMPLETED", "FAILED"), (5, "PENDING", "PENDING")]
    waits = attempts.requeue_backoff(meta, ledger, "embedding", F.lit(NOW), wait_seconds=61, limit=9).collect()
    assert {r.metadata_id: r.embedding_status for r in waits} == {
        1: "PENDING", 2: "FAILED", 3: "FAILED", 4: "COMPLETED", 5: "PENDING", 6: None}
    counted = attempts.funnel_with_attempts(meta, ledger, "embedding")
    assert {(r.status, r.attempts): r.documents for r in counted.collect()} == {
        ("FAILED", 0): 1, ("FAILED", 3): 1, ("FAILED", 2): 1, ("COMPLETED", 3): 1, ("FAILED", 1): 1, (None, 0): 1}


def test_download_job_with_manifest_and_weights(spark, tmp_path):
    to = jobs.Corpus(spark, "weighted", root=str(tmp_path / "corpus"), part_width=50)
    to.create()
    some = spark.range(30).select(
        F.col("id").alias("metadata_id"), F.concat(F.lit(f"{tmp_path}/d/"), "id").alias("document_s3_path"), F.lit("N").alias("document_number"),
        F.col("id").alias("document_major_version"), F.lit("PENDING").alias("download_status"), (F.col("id") * 10).cast("bigint").alias("size"))
    absent = [F.lit(None).cast(f.dataType).alias(f.name) for f in METADATA if f.name not in some.columns]
    to.write(some.select("*", *absent), "docs_metadata")

    def fetch(frame):
        for row in frame.itertuples():
            yield "application/octet-stream", str(row.metadata_id).encode()

    jobs.download(to, fetch, manifest=str(tmp_path / "manifest"), task_bytes=500)
    assert to.read("docs_metadata").filter("download_status = 'COMPLETED'").count() == 30
    assert spark.read.schema(writers.MANIFEST).parquet(str(tmp_path / "manifest")).count() == 30
    assert rows(to.read("docs_metadata").filter("is_latest_doc_in_dl"), "metadata_id") == [(29,)]
