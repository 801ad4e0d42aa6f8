"""All six jobs over real tables, with documents that fail at every stage."""

import pytest
from conftest import rows
from docloom.functions.text import page_array
from docloom.operators import corpus, stages
from docloom.plans import fixtures as fx
from docloom.plans import jobs
from docloom.schemas import EXPORT_FIELDS
from docloom.staging import scratch_path
from pyspark.sql import functions as F


@pytest.fixture(scope="module", params=[(None, None), (4, None), (None, 20)], ids=["plain", "bucketed", "parts"])
def built(spark, small, request):
    buckets, width = request.param
    name = f"jobs_{buckets or 0}_{width or 0}"
    to = jobs.Corpus(spark, name, buckets=buckets, as_of=F.lit(fx.NOW).cast("timestamp"), part_width=width,
                     root=scratch_path(spark, "parts") if width else None)
    if width is None:
        spark.sql(f"CREATE DATABASE {name} LOCATION '{scratch_path(spark, name)}'")
    to.create()
    export = fx.export(fx.metadata(spark, small))
    export = export.select("*", *[F.lit(None).cast("string").alias(f"{n}") for n in EXPORT_FIELDS if n not in export.columns])
    root = scratch_path(spark, "landed").replace("file:", "")
    jobs.load_metadata(to, export, root)
    texts = fx.table(spark, small, "documents").select((F.col("doc_id") + 100000).alias("document_id"), "text")

    def fetch(frame):
        for row in frame.itertuples():
            kind = "text/html" if row.document_id % 10 == 7 else "application/octet-stream"
            yield kind, str(row.document_id).encode()

    def read_pages(batch):
        landed = to.read("docs_metadata").select("metadata_id", "document_id")
        content = batch.join(landed, "metadata_id").join(texts, "document_id")
        text = F.when(F.col("document_id") % 10 != 1, F.col("text"))
        return corpus.with_pages(content, page_array(text)).select(
            "metadata_id", "document_s3_path", "pdf_text", "extraction_status")

    jobs.download(to, fetch, 4)
    jobs.extract(to, read_pages)
    jobs.chunk(to)
    jobs.embed(to, lambda chunks: corpus.embed_hashing(chunks, 16))
    jobs.index(to)
    return to, export, read_pages, root


def test_every_document_ends_in_a_definite_state(built, spark):
    to = built[0]
    meta = to.read("docs_metadata")
    assert meta.count() == 160 and meta.select("metadata_id").distinct().count() == 160
    states = {tuple(r)[:5]: r.documents for r in stages.funnel(meta).collect()}
    assert states == {
        ("COMPLETED",) * 5: 120,
        ("FAILED", "PENDING", "PENDING", "PENDING", "PENDING"): 20,
        ("COMPLETED", "FAILED", "PENDING", "PENDING", "PENDING"): 20,
    }


def test_search_table_matches_chunks_and_holds_latest_versions_only(built, spark):
    to = built[0]
    meta, chunks, table = to.read("docs_metadata"), to.read("docs_embeddings"), to.read("docs_embeddings_sync")
    latest = meta.filter("is_latest_doc_in_dl").select("metadata_id")
    assert rows(table, "chunk_id") == rows(chunks.join(latest, "metadata_id", "left_semi"), "chunk_id")
    assert 0 < table.count() < chunks.count()
    assert chunks.filter("embedding IS NULL OR size(embedding) <> 16").count() == 0


def test_loading_again_changes_nothing(built, spark):
    to, export, _, root = built
    before = rows(to.read("docs_metadata"), "metadata_id", "document_number", "index_status")
    jobs.load_metadata(to, export, root)
    assert rows(to.read("docs_metadata"), "metadata_id", "document_number", "index_status") == before


def test_bad_rows_are_kept_apart_and_loading_thrice_changes_nothing(built, spark):
    to, export, _, root = built
    bad = export.limit(3).withColumns({"major_version_number__v": F.lit("no number"), "id": (F.col("id").cast("long") + 10**6).cast("string")})
    keyless = export.limit(2).withColumn("document_number__v", F.lit(None).cast("string"))
    before, rejects = rows(to.read("docs_metadata"), "metadata_id", "document_number"), scratch_path(spark, "rejects")
    for _ in range(3):
        jobs.load_metadata(to, export.unionByName(bad).unionByName(keyless), root, rejects=rejects)
    assert rows(to.read("docs_metadata"), "metadata_id", "document_number") == before
    assert sorted(r.reason for r in spark.read.parquet(rejects).collect()) == ["no version key"] * 2 + ["value of another type"] * 3


def test_requeued_documents_are_chunked_again_under_the_same_ids(built, spark):
    to, _, read_pages, _ = built
    ids = rows(to.read("docs_embeddings"), "chunk_id")
    table = rows(to.read("docs_embeddings_sync"), "chunk_id", "chunk_text")
    some = F.col("chunking_status") == "COMPLETED"
    to.write(stages.requeue(to.read("docs_metadata"), "chunking", some), "docs_metadata")
    jobs.chunk(to)
    assert to.read("docs_embeddings").filter("embedding_status IS NOT NULL").count() == 0
    jobs.embed(to, lambda chunks: corpus.embed_hashing(chunks, 16))
    jobs.index(to)
    assert rows(to.read("docs_embeddings"), "chunk_id") == ids
    assert rows(to.read("docs_embeddings_sync"), "chunk_id", "chunk_text") == table
    assert to.read("docs_metadata").filter("index_status = 'COMPLETED'").count() == 120


def test_a_small_batch_writes_only_the_parts_it_touches(built, spark):
    to = built[0]
    if to.part_width is None:
        return
    tables = ("docs_metadata", "docs_pages", "docs_embeddings", "docs_embeddings_sync")
    some = to.read("docs_metadata").filter("index_status = 'COMPLETED' AND metadata_id < 30").select("metadata_id").limit(1).collect()[0].metadata_id
    to.update("docs_metadata", spark.createDataFrame([(some,)], "metadata_id long"),
              lambda known: stages.requeue(known, "chunking", F.col("metadata_id") == some))
    before = {t: to.versioned(t).folders(to.versioned(t).latest()) for t in tables}
    jobs.chunk(to)
    jobs.embed(to, lambda chunks: corpus.embed_hashing(chunks, 16))
    jobs.index(to)
    after = {t: to.versioned(t).folders(to.versioned(t).latest()) for t in tables}
    differing = {t: [p for p in after[t].keys() | before[t].keys() if after[t].get(p) != before[t].get(p)] for t in tables}
    assert {t: len(p) for t, p in differing.items()} == {"docs_metadata": 1, "docs_pages": 0, "docs_embeddings": 1, "docs_embeddings_sync": 1}
    assert len(before["docs_metadata"]) == 9
    assert to.read("docs_metadata").filter("index_status = 'COMPLETED'").count() == 120
