import pytest
from conftest import rows
from docloom.operators import sync
from docloom.staging import scratch_path
from docloom.streaming import sync_stream
from docloom.streaming.sync_log import SyncLog
from pyspark.sql import functions as F
from pyspark.sql import types as T

SCHEMA = "chunk_id bigint, chunk_text string, embedding_status string, audit__updated_date timestamp"


def at(day):
    return F.lit(f"2024-01-{day:02d}").cast("timestamp")


def log(spark, data):
    raw = spark.createDataFrame(data, "chunk_id bigint, chunk_text string, embedding_status string, day int")
    return raw.select("chunk_id", "chunk_text", "embedding_status",
                      F.make_timestamp(F.lit(2024), F.lit(1), "day", F.lit(0), F.lit(0), F.lit(0)).alias("audit__updated_date"))


def test_upsert_only_when_strictly_newer(spark):
    def table(data):
        return log(spark, data).drop("embedding_status").withColumn("document_title", F.concat(F.lit("T"), "chunk_text"))

    target = table([(1, "a", "", 5), (2, "b", "", 5), (3, "c", "", 5)])
    source = table([(1, "A", "", 6), (2, "B", "", 5), (4, "D", "", 1)])
    out = sync.upsert_search_rows(target, source, at(9))
    assert rows(out, "chunk_id", "chunk_text", "document_title") == [
        (1, "A", "Ta"), (2, "b", "Tb"), (3, "c", "Tc"), (4, "D", "TD")]
    assert rows(sync.upsert_search_rows(out, source, at(9))) == rows(out)


def test_prune(spark):
    table = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "chunk_id bigint, chunk_text string")
    chunks = spark.createDataFrame([(1, 10), (3, 30)], "chunk_id bigint, metadata_id bigint")
    old = spark.createDataFrame([(30,)], "metadata_id bigint")
    assert rows(sync.prune(table, chunks), "chunk_id") == [(1,), (3,)]
    assert rows(sync.prune(table, chunks, old), "chunk_id") == [(1,)]


def test_denormalise_keeps_chunks_of_unknown_documents_and_drops_failed_ones(spark):
    chunks = spark.createDataFrame(
        [(1, 10, "a", [1.0], "COMPLETED"), (2, 10, "b", [], "FAILED"), (3, 99, "c", [1.0], "COMPLETED")],
        "chunk_id bigint, metadata_id bigint, chunk_text string, embedding array<float>, embedding_status string"
    ).withColumn("audit__updated_date", at(1))
    meta = spark.createDataFrame([(10, "D", "Approved", "2024-01-02T03:04:05.678Z")],
        "metadata_id bigint, document_number string, status string, file_modified_date string").withColumn(
        "audit__updated_date", at(2))
    out = sync.denormalise(chunks, meta)
    assert rows(out, "chunk_id", "document_number", "document_status") == [(1, "D", "Approved"), (3, None, None)]
    assert rows(out.filter("chunk_id = 1").select(F.date_format("audit__updated_date", "dd"),
                F.date_format("file_modified_date", "HH:mm"))) == [("01", "03:04")]


def test_stream_equals_batch_and_restarts_add_nothing(spark):
    feed, out, progress = (scratch_path(spark, n) for n in ("feed", "out", "progress"))
    loads = [[(1, "a", "COMPLETED", 1), (2, "b", "FAILED", 1)], [(1, "a2", "COMPLETED", 2), (3, "c", "COMPLETED", 1)],
             [(2, "b2", "COMPLETED", 3), (3, "c0", "COMPLETED", 1)]]
    columns = ["chunk_id", "chunk_text", "audit__updated_date"]

    def trigger():
        sync_stream.sync_once(sync_stream.change_stream(spark, feed, log(spark, loads[0]).schema, 1), out, progress, columns)
        return spark.read.parquet(out)

    for n, load in enumerate(loads):
        log(spark, load).write.mode("append").parquet(feed)
        trigger()
        assert trigger().count() == sum(len(part) for part in loads[:n + 1])
    batch = log(spark, [r for part in loads for r in part]).withColumn("gone", F.col("embedding_status") != "COMPLETED").select(*columns, "gone")
    assert rows(sync.latest_per_chunk(trigger())) == rows(sync.latest_per_chunk(batch))
    assert rows(sync.latest_per_chunk(batch), "chunk_id", "chunk_text") == [(1, "a2"), (2, "b2"), (3, "c0")]


def test_failed_and_deleted_chunks_leave_the_state(spark):
    feed, out, progress = (scratch_path(spark, n) for n in ("feed", "out", "progress"))
    columns = ["chunk_id", "chunk_text", "audit__updated_date"]
    loads = [[(1, "a", "COMPLETED", 1, "insert"), (2, "b", "COMPLETED", 1, "insert"), (3, "c", "COMPLETED", 1, "insert")],
             [(1, "a", "FAILED", 2, "update"), (2, "b", "COMPLETED", 2, "delete"), (3, "c", "COMPLETED", 1, "delete")],
             [(2, "b3", "COMPLETED", 3, "insert")]]
    states = []
    for load in loads:
        change = log(spark, [r[:4] for r in load]).join(spark.createDataFrame([(r[0], r[4]) for r in load], "chunk_id bigint, change_type string"), "chunk_id")
        change.write.mode("append").parquet(feed)
        sync_stream.sync_once(sync_stream.change_stream(spark, feed, change.schema, 1), out, progress, columns)
        states.append(rows(sync.latest_per_chunk(spark.read.parquet(out)), "chunk_id", "chunk_text"))
    assert states == [[(1, "a"), (2, "b"), (3, "c")], [], [(2, "b3")]]
    compacted = sync.compact_log(spark.read.parquet(out), scratch_path(spark, "compacted"))
    assert rows(compacted, "chunk_id", "chunk_text", "gone") == [(2, "b3", False)]


def test_sync_compact_sync(spark):
    feed = scratch_path(spark, "feed")
    kept = SyncLog(spark, scratch_path(spark, "log"), T.StructType.fromDDL("chunk_id bigint, chunk_text string, audit__updated_date timestamp"))
    assert kept.read().count() == 0 and kept.compacted() == (0, None)
    loads = [[(1, "a", "COMPLETED", 1), (2, "b", "COMPLETED", 1), (3, "c", "COMPLETED", 1)], [(1, "a2", "COMPLETED", 2), (2, "b", "FAILED", 2)],
             [(2, "b3", "COMPLETED", 3), (4, "d", "COMPLETED", 3)], [(3, "c", "FAILED", 4), (1, "old", "COMPLETED", 1)]]
    schema = log(spark, loads[0]).schema
    sync_now = lambda: kept.sync(sync_stream.change_stream(spark, feed, schema, 1))
    for n, load in enumerate(loads):
        log(spark, load).write.mode("append").parquet(feed)
        sync_now()
        sync_now()
        taken = log(spark, [r for part in loads[:n + 1] for r in part])
        want = rows(sync.latest_per_chunk(sync_stream.as_log(taken, schema.names[:2] + schema.names[3:])))
        assert rows(kept.read()) == want
        if n in (1, 2):
            assert kept.compact() == n
            assert rows(kept.read()) == want and rows(kept.changes(), "chunk_id", "audit__updated_date", "chunk_text", "gone") == [(*r, False) for r in want]
    assert rows(kept.read(), "chunk_id", "chunk_text") == [(1, "a2"), (2, "b3"), (4, "d")]
    # Of the log, readers open the generation after the last compaction only.
    assert kept.changes().count() == 4 + 2 and [g for g, _ in kept.bases()] == [1, 2]


def test_a_compaction_that_breaks_off_changes_nothing(spark, monkeypatch):
    feed = scratch_path(spark, "feed")
    kept = SyncLog(spark, scratch_path(spark, "log"), T.StructType.fromDDL("chunk_id bigint, chunk_text string, audit__updated_date timestamp"))
    first = log(spark, [(1, "a", "COMPLETED", 1), (2, "b", "FAILED", 1)])
    first.write.parquet(feed)
    kept.sync(sync_stream.change_stream(spark, feed, first.schema))
    before = rows(kept.read())
    monkeypatch.setattr(type(spark), "createDataFrame", lambda *_: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        kept.compact()
    monkeypatch.undo()
    assert rows(kept.read()) == before and kept.compacted() == (0, None)
    assert kept.compact() == 1 and rows(kept.read()) == before
