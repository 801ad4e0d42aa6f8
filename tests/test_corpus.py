import pandas as pd
from conftest import rows
from docloom.functions.text import page_array
from docloom.operators import corpus, stages
from docloom.schemas import STAGES
from docloom.sources import readers, writers
from docloom.staging import stage
from pyspark.sql import functions as F

PAGES = "metadata_id bigint, pdf_text array<struct<page_number: int, page_text: string, total_pages: int>>"


def test_failed_extraction_is_recorded(spark):
    df = spark.createDataFrame([(1, "abc"), (2, None), (3, "")], "metadata_id bigint, text string")
    out = corpus.with_pages(df, page_array(F.col("text")), F.lit("gone")).collect()
    assert [(r.extraction_status, r.pdf_text[0].page_number, r.pdf_text[0].page_text) for r in out] == [
        ("COMPLETED", 1, "abc"), ("FAILED", -1, "Error: gone"), ("FAILED", -1, "Error: gone")]


def test_decoder_errors_stay_in_their_row(spark):
    df = spark.createDataFrame([(1, bytearray(b"one\ftwo")), (2, bytearray(b"\xff")), (3, None)], "id bigint, body binary")

    def decode(body):
        parts = body.decode("utf-8").split("\f")
        return [(i + 1, p, len(parts)) for i, p in enumerate(parts)]

    out = {r.id: r for r in corpus.decode_pages(df, "body", decode, ["id"], partitions=2).collect()}
    assert [p.page_text for p in out[1].pdf_text] == ["one", "two"] and out[1].extraction_status == "COMPLETED"
    for bad in (2, 3):
        assert out[bad].extraction_status == "FAILED" and out[bad].pdf_text[0].page_number == -1
        assert out[bad].pdf_text[0].page_text.startswith("Error: ")


def test_documents_without_pages(spark):
    df = spark.createDataFrame([(1, [(1, "a", 2), (2, "b", 2)]), (2, []), (3, None)], PAGES)
    assert rows(corpus.chunk_pages(df), "metadata_id", "document_page_number") == [(1, 1), (1, 2)]
    assert rows(corpus.chunk_outcome(df)) == [(1, 2, "COMPLETED"), (2, 0, "FAILED"), (3, 0, "FAILED")]


CHUNKS = "chunk_id bigint, metadata_id bigint, chunk_text string"


def test_model_slot_isolates_bad_texts(spark):
    df = spark.createDataFrame([(1, 1, "ok"), (2, 1, ""), (3, 1, None), (4, 2, "bad"), (5, 2, "fine")], CHUNKS)

    def make():
        def score(texts):
            if "bad" in texts:
                raise RuntimeError("rejected")
            return [[float(len(t)), 1.0] for t in texts]
        return score

    out = {r.chunk_id: r for r in corpus.embed_chunks(df.coalesce(1), make, waits=(0.0,)).collect()}
    assert [out[i].embedding_status for i in range(1, 6)] == ["COMPLETED", "FAILED", "FAILED", "FAILED", "COMPLETED"]
    assert out[1].embedding == [2.0, 1.0] and out[4].embedding == [] and out[5].embedding == [4.0, 1.0]


def test_attempts():
    calls = []

    def flaky():
        calls.append(1)
        if len(calls) < 3:
            raise ValueError("not yet")
        return "done"

    assert corpus.attempt(flaky, (0, 0, 0)) == ("done", None) and len(calls) == 3
    calls.clear()
    assert corpus.attempt(lambda: calls.append(1) or 1 / 0, (0, 0, 0))[1] == "division by zero" and len(calls) == 4


def test_hashing_embedding(spark):
    df = spark.createDataFrame([(1, 1, "The cat sat"), (2, 1, "sat THE cat"), (3, 1, ""), (4, 1, None)], CHUNKS)
    out = {r.chunk_id: r for r in corpus.embed_hashing(df, 32).collect()}
    assert out[1].embedding == out[2].embedding and abs(sum(x * x for x in out[1].embedding) - 1) < 1e-5
    assert [out[i].embedding_status for i in (1, 3, 4)] == ["COMPLETED", "FAILED", "FAILED"] and out[4].embedding == []


def test_precomputed_vectors(spark):
    chunks = spark.createDataFrame([(1, 1, "a", 7), (2, 1, "", 7), (3, 1, None, 7), (4, 1, "a", 8)], CHUNKS + ", v int")
    vectors = spark.createDataFrame([(7, [0.5, 0.5])], "v int, embedding array<float>")
    out = {r.chunk_id: (r.embedding_status, r.embedding) for r in corpus.embed_from_vectors(chunks, vectors, "v").collect()}
    assert out == {1: ("COMPLETED", [0.5, 0.5]), 2: ("FAILED", []), 3: ("FAILED", []), 4: ("FAILED", [])}


def test_rollup_states(spark):
    df = spark.createDataFrame(
        [(1, "COMPLETED"), (1, "COMPLETED"), (2, "COMPLETED"), (2, "FAILED"), (3, "FAILED"), (4, None), (4, "COMPLETED")],
        "metadata_id bigint, embedding_status string")
    assert rows(stages.status_rollup(df), "metadata_id", "final_status") == [
        (1, "COMPLETED"), (2, "PARTIAL_SUCCESS"), (3, "FAILED"), (4, "PARTIAL_SUCCESS")]


def test_requeue_touches_later_stages_only(spark):
    columns = [s.column for s in STAGES]
    df = spark.createDataFrame([(1, *["FAILED"] * 5), (2, *["COMPLETED"] * 5)],
                               "metadata_id bigint, " + ", ".join(f"{c} string" for c in columns))
    again = stages.requeue(df, "chunking", F.col("chunking_status") == "FAILED")
    assert rows(again, *columns) == [tuple(["COMPLETED"] * 5), ("FAILED", "FAILED", "PENDING", "PENDING", "PENDING")]


def test_landing_and_reading_back(spark, tmp_path):
    df = spark.createDataFrame(
        [(1, f"{tmp_path}/x/1.bin", "application/octet-stream"), (2, f"{tmp_path}/x/2.bin", "text/html"),
         (3, f"{tmp_path}/x/3.bin", "boom"), (4, f"file://{tmp_path}/y/4.bin", "application/octet-stream; q=1")],
        "metadata_id bigint, document_s3_path string, kind string")

    def fetch(frame: pd.DataFrame):
        for row in frame.itertuples():
            if row.kind == "boom":
                raise OSError("no such object")
            yield row.kind, b"x" * row.metadata_id

    landed = stage(writers.land_files(df, fetch, partitions=2), "landed")
    assert rows(landed) == [(1, "COMPLETED", None), (2, "FAILED", "content type text/html"), (3, "FAILED", "OSError: no such object"), (4, "COMPLETED", None)]
    assert rows(readers.read_binary(spark, str(tmp_path), "*.bin"), "length") == [(1,), (4,)]
