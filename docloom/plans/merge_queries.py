"""Queries over merges, life-cycle write-backs, change sets and the search table."""

from __future__ import annotations

from pyspark.sql import functions as F

from docloom.operators import merge as mg
from docloom.operators import stages, sync, versions
from docloom.operators.corpus import embed_from_vectors
from docloom.plans import fixtures as fx
from docloom.plans import jobs
from docloom.plans.table_queries import query
from docloom.schemas import COMPLETED, DEFAULTS, FAILED, VERSION_KEY, VIEWABLE_RENDITION
from docloom.staging import scratch_path, stage
from docloom.streaming import sync_stream

_SHOW = "yyyy-MM-dd HH:mm:ss"


def _time(text):
    return F.lit(text).cast("timestamp")


def _shown(column):
    return F.date_format(column, _SHOW).alias(column)


def _known(spark, sf_dir):
    """The metadata table before the batch: every document seen so far, with its flag and audit time."""
    return fx.metadata(spark, sf_dir).withColumns({
        "is_latest_doc_in_dl": F.lit(True), "audit__updated_date": _time(fx.EARLIER)})


_LABELLED = """labelled AS (SELECT doc_id AS metadata_id, CASE WHEN quality = 1 THEN 'COMPLETED' ELSE 'FAILED' END
               AS status FROM labels)"""


def _labelled(spark, sf_dir):
    return fx.table(spark, sf_dir, "labels").select(
        F.col("doc_id").alias("metadata_id"), F.when(F.col("quality") == 1, COMPLETED).otherwise(FAILED).alias("status"))


@query("""SELECT metadata_id, document_number, document_title, download_status FROM fx_meta
          WHERE download_status <> 'PENDING'
          UNION ALL SELECT metadata_id, document_number, document_title, 'PENDING' FROM fx_batch b
          WHERE rendition_type = 'viewable_rendition__v' AND NOT EXISTS (SELECT 1 FROM fx_meta m
            WHERE m.download_status <> 'PENDING' AND m.document_number = b.document_number
            AND m.document_minor_version = b.document_minor_version
            AND m.document_major_version = b.document_major_version)""", "fx_batch")
def merge_insert_only(spark, sf_dir):
    target = fx.metadata(spark, sf_dir).filter("download_status <> 'PENDING'")
    source = fx.batch(spark, sf_dir).filter(F.col("rendition_type") == VIEWABLE_RENDITION)
    merged = mg.merge(target, source, VERSION_KEY, not_matched=mg.Insert(defaults=DEFAULTS["docs_metadata"]))
    return merged.select("metadata_id", "document_number", "document_title", "download_status")


@query("""SELECT metadata_id, document_number, download_status, extraction_status, index_status, true
          AS is_latest_doc_in_dl, size IS NULL AS no_size FROM fx_meta
          UNION ALL SELECT metadata_id, document_number, 'PENDING', 'PENDING', 'PENDING', true, true FROM fx_batch
          WHERE metadata_id NOT IN (SELECT metadata_id FROM fx_meta)""", "fx_batch")
def insert_defaults(spark, sf_dir):
    source = fx.batch(spark, sf_dir).select("metadata_id", "document_number")
    merged = mg.merge(_known(spark, sf_dir), source, ["metadata_id"],
                      not_matched=mg.Insert(defaults=DEFAULTS["docs_metadata"]))
    return merged.select(
        "metadata_id", "document_number", "download_status", "extraction_status", "index_status",
        "is_latest_doc_in_dl", F.col("size").isNull().alias("no_size"))


@query(f"""WITH {_LABELLED} SELECT m.metadata_id, coalesce(l.status, m.download_status) AS download_status,
          CASE WHEN l.status IS NULL THEN '{fx.EARLIER}' ELSE '{fx.NOW}' END AS audit__updated_date
          FROM fx_meta m LEFT JOIN labelled l USING (metadata_id)""", "fx_meta")
def merge_update_status(spark, sf_dir):
    merged = mg.update_column(_known(spark, sf_dir), _labelled(spark, sf_dir), "metadata_id", "download_status",
                              "status", as_of=_time(fx.NOW))
    return merged.select("metadata_id", "download_status", _shown("audit__updated_date"))


@query("""SELECT metadata_id, r = 1 AS is_latest_doc_in_dl FROM (SELECT metadata_id, rank() OVER (
          PARTITION BY document_number ORDER BY document_major_version DESC, document_minor_version DESC) AS r
          FROM fx_meta)""", "fx_meta")
def merge_flag_superseded(spark, sf_dir):
    known = _known(spark, sf_dir)
    old = versions.superseded(known)
    flag = {"is_latest_doc_in_dl": F.lit(False), "audit__updated_date": _time(fx.NOW)}
    return mg.merge(known, old, ["metadata_id"], [mg.Update(flag)]).select("metadata_id", "is_latest_doc_in_dl")


@query(f"""WITH target AS (SELECT metadata_id, count(*) AS n_pages, sum(length(page_text)) AS n_chars
            FROM fx_pages_before GROUP BY metadata_id),
          source AS (SELECT CASE WHEN lang = 'en' THEN metadata_id ELSE metadata_id + 1000000 END AS metadata_id,
            count(*) AS n_pages, sum(length(page_text)) AS n_chars FROM fx_pages_after GROUP BY metadata_id, lang)
          SELECT metadata_id, coalesce(s.n_pages, t.n_pages) AS n_pages,
            CAST(coalesce(s.n_chars, t.n_chars) AS BIGINT) AS n_chars,
            CASE WHEN t.metadata_id IS NULL THEN '{fx.NOW}' ELSE '{fx.EARLIER}' END AS audit__created_date,
            CASE WHEN s.metadata_id IS NULL THEN '{fx.EARLIER}' ELSE '{fx.NOW}' END AS audit__updated_date
          FROM target t FULL OUTER JOIN source s USING (metadata_id)""", "fx_pages_before", "fx_pages_after")
def merge_upsert_pages(spark, sf_dir):
    target = fx.page_documents(spark, sf_dir, fx.BEFORE).withColumns({
        "extraction_status": F.lit(COMPLETED), "audit__created_date": _time(fx.EARLIER),
        "audit__updated_date": _time(fx.EARLIER)}).drop("lang")
    source = fx.page_documents(spark, sf_dir, fx.AFTER).withColumns({
        "metadata_id": F.when(F.col("lang") == "en", F.col("metadata_id")).otherwise(F.col("metadata_id") + 1000000),
        "extraction_status": F.lit(COMPLETED)})
    source = stage(source, "source")
    now = _time(fx.NOW)
    merged = mg.merge(
        target, source, ["metadata_id"],
        [mg.Update({"pdf_text": F.col("src.pdf_text"), "extraction_status": F.col("src.extraction_status"),
                    "audit__updated_date": now})],
        mg.Insert({"metadata_id": F.col("metadata_id"), "pdf_text": F.col("pdf_text"),
                   "extraction_status": F.col("extraction_status"), "audit__created_date": now,
                   "audit__updated_date": now}))
    lengths = F.aggregate("pdf_text", F.lit(0).cast("bigint"), lambda acc, p: acc + F.length(p["page_text"]))
    return merged.select(
        "metadata_id", F.size("pdf_text").cast("bigint").alias("n_pages"), lengths.alias("n_chars"),
        _shown("audit__created_date"), _shown("audit__updated_date"))


@query("""SELECT chunk_id, metadata_id, chunk_text, document_page_number FROM fx_chunks_before
          WHERE metadata_id NOT IN (SELECT doc_id FROM labels)
          UNION ALL SELECT chunk_id, metadata_id, chunk_text, document_page_number FROM fx_chunks_after
          WHERE metadata_id IN (SELECT doc_id FROM labels)""", "fx_chunks_before", "fx_chunks_after")
def merge_replace_by_key(spark, sf_dir):
    columns = ["chunk_id", "metadata_id", "chunk_text", "document_page_number"]
    target = fx.chunks(spark, sf_dir, fx.BEFORE).select(*columns)
    rechunked = stages.in_batch(fx.chunks(spark, sf_dir, fx.AFTER), _labelled(spark, sf_dir)).select(*columns)
    return mg.replace_by_key(target, stage(rechunked, "rechunked"), "metadata_id")


@query("""SELECT c.chunk_id, c.embedding_status, CAST(coalesce(len(e.embedding), 0) AS INTEGER) AS dimensions,
          round(coalesce(list_sum(CAST(e.embedding AS DOUBLE[])), 0), 3) AS total
          FROM fx_chunks c LEFT JOIN embeddings e USING (vec_id)""", "fx_chunks")
def merge_vectors(spark, sf_dir):
    chunks = fx.chunks(spark, sf_dir)
    target = chunks.select("chunk_id", F.lit(None).cast("array<float>").alias("embedding"),
                           F.lit(None).cast("string").alias("embedding_status"))
    source = stage(embed_from_vectors(chunks, fx.table(spark, sf_dir, "embeddings"), "vec_id"), "vectors")
    merged = mg.merge(target, source, ["chunk_id"], [mg.Update({
        "embedding": F.col("src.embedding"), "embedding_status": F.col("src.embedding_status")})])
    total = F.aggregate("embedding", F.lit(0.0), lambda acc, x: acc + x.cast("double"))
    return merged.select("chunk_id", "embedding_status", F.size("embedding").alias("dimensions"),
                         F.round(total, 3).alias("total"))


# Target rows are all of EARLIER; source rows of restricted documents are as old, the others newer.
@query(f"""WITH target AS (SELECT c.*, m.document_title AS t FROM fx_chunks_before c JOIN fx_meta m USING (metadata_id)
            WHERE c.embedding_status = 'COMPLETED'),
          source AS (SELECT c.*, concat(m.document_title, ' (revised)') AS t,
            m.classification <> 'Restricted' AS newer FROM fx_chunks_after c JOIN fx_meta m USING (metadata_id)
            WHERE c.embedding_status = 'COMPLETED')
          SELECT chunk_id, coalesce(t.t, s.t) AS document_title,
            CASE WHEN t.chunk_id IS NULL OR (s.chunk_id IS NOT NULL AND s.newer) THEN s.chunk_text
              ELSE t.chunk_text END AS chunk_text,
            CASE WHEN t.chunk_id IS NULL OR (s.chunk_id IS NOT NULL AND s.newer) THEN '{fx.NOW}'
              ELSE '{fx.EARLIER}' END AS audit__updated_date
          FROM target t FULL OUTER JOIN source s USING (chunk_id)""",
       "fx_chunks_before", "fx_chunks_after", "fx_meta")
def merge_conditional(spark, sf_dir):
    meta = fx.metadata(spark, sf_dir)
    columns = ["chunk_id", "document_title", "chunk_text", "audit__updated_date"]
    old = fx.chunks(spark, sf_dir, fx.BEFORE).withColumn("audit__updated_date", _time(fx.EARLIER))
    target = sync.denormalise(old, meta, columns)
    revised = meta.withColumn("document_title", F.concat("document_title", F.lit(" (revised)")))
    restricted = meta.select("metadata_id", (F.col("classification") == "Restricted").alias("restricted"))
    stamped = F.when(F.col("restricted"), _time(fx.EARLIER)).otherwise(_time(fx.LATER))
    new = fx.chunks(spark, sf_dir, fx.AFTER).join(restricted, "metadata_id").withColumn(
        "audit__updated_date", stamped)
    source = sync.denormalise(new, revised, columns)
    target, source = stage(target, "target"), stage(source, "source")
    merged = sync.upsert_search_rows(target, source, as_of=_time(fx.NOW))
    return merged.select("chunk_id", "document_title", "chunk_text", _shown("audit__updated_date"))


@query("""SELECT coalesce(a.chunk_id, b.chunk_id) AS chunk_id,
          CASE WHEN b.chunk_id IS NULL THEN 'insert' WHEN a.chunk_id IS NULL THEN 'delete' ELSE 'update' END
            AS change_type,
          CASE WHEN a.chunk_id IS NULL THEN b.chunk_text ELSE a.chunk_text END AS chunk_text,
          CASE WHEN a.chunk_id IS NULL THEN b.vec_id ELSE a.vec_id END AS vec_id
          FROM fx_chunks_before b FULL OUTER JOIN fx_chunks_after a ON a.chunk_id = b.chunk_id
          WHERE a.chunk_id IS NULL OR b.chunk_id IS NULL OR a.chunk_text IS DISTINCT FROM b.chunk_text
            OR a.vec_id IS DISTINCT FROM b.vec_id""", "fx_chunks_before", "fx_chunks_after")
def change_set(spark, sf_dir):
    before = fx.chunks(spark, sf_dir, fx.BEFORE)
    after = fx.chunks(spark, sf_dir, fx.AFTER)
    return mg.change_set(before, after, "chunk_id", ["chunk_text", "vec_id"])


@query("""SELECT metadata_id, CASE WHEN index_status = 'PENDING' AND embedding_status IN ('COMPLETED',
          'PARTIAL_SUCCESS') THEN embedding_status ELSE index_status END AS index_status FROM fx_meta""", "fx_meta")
def index_status_carry(spark, sf_dir):
    known = _known(spark, sf_dir)
    batch = stages.carry_status(stages.gated(known, "index", "embedding_status"))
    return mg.update_column(known, batch, "metadata_id", "index_status", as_of=_time(fx.NOW)).select(
        "metadata_id", "index_status")


@query("""SELECT metadata_id, download_status,
          CASE WHEN extraction_status = 'FAILED' OR embedding_status = 'FAILED' THEN 'PENDING'
            ELSE extraction_status END AS extraction_status,
          CASE WHEN extraction_status = 'FAILED' OR embedding_status = 'FAILED' THEN 'PENDING'
            ELSE chunking_status END AS chunking_status,
          CASE WHEN extraction_status = 'FAILED' OR embedding_status = 'FAILED' THEN 'PENDING'
            ELSE embedding_status END AS embedding_status,
          CASE WHEN extraction_status = 'FAILED' OR embedding_status = 'FAILED' THEN 'PENDING'
            ELSE index_status END AS index_status FROM fx_meta""", "fx_meta")
def requeue(spark, sf_dir):
    again = stages.any_failed(["extraction_status", "chunking_status", "embedding_status", "index_status"])
    return stages.requeue(fx.metadata(spark, sf_dir), "extraction", again).select(
        "metadata_id", "download_status", "extraction_status", "chunking_status", "embedding_status", "index_status")


@query("""SELECT c.chunk_id, m.document_number, c.chunk_text, c.document_page_number, c.document_total_pages,
          m.document_title, m.document_type, m.document_subtype, m.classification, m.document_id,
          m.status AS document_status, m.doc_control_name, m.document_major_version, m.is_latest_version,
          strftime(try_strptime(m.version_modified_date, '%Y-%m-%dT%H:%M:%S.%gZ'), '%Y-%m-%d %H:%M:%S')
            AS version_modified_date
          FROM fx_chunks c LEFT JOIN fx_meta m USING (metadata_id) WHERE c.embedding_status = 'COMPLETED'""",
       "fx_chunks", "fx_meta")
def sync_denormalise(spark, sf_dir):
    wide = sync.denormalise(fx.chunks_with_vectors(spark, sf_dir), fx.metadata(spark, sf_dir))
    return wide.select(
        "chunk_id", "document_number", "chunk_text", "document_page_number", "document_total_pages",
        "document_title", "document_type", "document_subtype", "classification", "document_id", "document_status",
        "doc_control_name", "document_major_version", "is_latest_version", _shown("version_modified_date"))


@query("""SELECT chunk_id, document_title FROM fx_chunks_before b JOIN fx_meta USING (metadata_id)
          WHERE b.embedding_status = 'COMPLETED' AND chunk_id IN (SELECT chunk_id FROM fx_chunks_after
            WHERE metadata_id NOT IN (SELECT metadata_id FROM (SELECT metadata_id, rank() OVER (
              PARTITION BY document_number ORDER BY document_major_version DESC, document_minor_version DESC) AS r
              FROM fx_meta) WHERE r > 1))""", "fx_chunks_before", "fx_chunks_after", "fx_meta")
def sync_prune(spark, sf_dir):
    meta = fx.metadata(spark, sf_dir)
    table = sync.denormalise(fx.chunks(spark, sf_dir, fx.BEFORE), meta, ["chunk_id", "document_title"])
    current = fx.chunks(spark, sf_dir, fx.AFTER)
    return sync.prune(table, current, versions.superseded(meta)).select("chunk_id", "document_title")


# The state after an initial load and a change set: only chunks that are still there and have a vector.
_LATEST = f"""SELECT a.chunk_id, a.chunk_text, a.vec_id, CASE WHEN b.chunk_id IS NULL OR a.chunk_text IS DISTINCT FROM b.chunk_text
      OR a.vec_id IS DISTINCT FROM b.vec_id OR a.embedding_status IS DISTINCT FROM b.embedding_status
      THEN '{fx.LATER}' ELSE '{fx.EARLIER}' END AS audit__updated_date
    FROM fx_chunks_after a LEFT JOIN fx_chunks_before b USING (chunk_id) WHERE a.embedding_status = 'COMPLETED'"""
_LOG = ["chunk_id", "chunk_text", "vec_id", "audit__updated_date"]


def _changes(spark, sf_dir):
    """A feed: everything as inserted first, then what was inserted, updated or deleted since."""
    before, after = fx.chunks(spark, sf_dir, fx.BEFORE), fx.chunks(spark, sf_dir, fx.AFTER)
    compared = ["chunk_text", "vec_id", "embedding_status"]
    first = before.select("chunk_id", F.lit("insert").alias("change_type"), *compared)
    since = mg.change_set(before, after, "chunk_id", compared)
    return first.withColumn("audit__updated_date", _time(fx.EARLIER)).unionByName(
        since.withColumn("audit__updated_date", _time(fx.LATER)))


@query("""SELECT CASE WHEN document_id % 7 = 0 THEN 'value of another type' ELSE 'no version key' END AS reason, document_id,
          count(*) AS n FROM fx_meta WHERE document_id % 7 = 0 OR document_id % 11 = 0 GROUP BY ALL""", "fx_meta")
def load_rejects(spark, sf_dir):
    """An export in which some versions are no numbers and some document numbers are missing, kept twice."""
    good = fx.export(fx.metadata(spark, sf_dir))
    damaged = good.withColumns({
        "major_version_number__v": F.when(F.col("id").cast("long") % 7 == 0, "x1").otherwise(F.col("major_version_number__v")),
        "document_number__v": F.when(F.col("id").cast("long") % 11 == 0, F.lit(None)).otherwise(F.col("document_number__v")),
    })
    path = scratch_path(spark, "rejects")
    for _ in range(2):
        jobs.keep_rejects(jobs.split_export(damaged, "landing")[1], path)
    kept = spark.read.parquet(path).withColumn("document_id", F.get_json_object("row", "$.id").cast("long"))
    return kept.groupBy("reason", "document_id").agg(F.count(F.lit(1)).alias("n"))


@query(_LATEST, "fx_chunks_before", "fx_chunks_after")
def sync_latest(spark, sf_dir):
    gone = (F.col("embedding_status") != COMPLETED) | (F.col("change_type") == "delete")
    log = _changes(spark, sf_dir).select(*_LOG, gone.alias("gone"))
    return sync.latest_per_chunk(log).select("chunk_id", "chunk_text", "vec_id", _shown("audit__updated_date"))


@query(_LATEST, "fx_chunks_before", "fx_chunks_after")
def stream_sync(spark, sf_dir):
    changes = _changes(spark, sf_dir)
    feed, log, progress = (scratch_path(spark, n) for n in ("feed", "log", "progress"))
    changes.write.parquet(feed)
    stream = sync_stream.change_stream(spark, feed, changes.schema)
    sync_stream.sync_once(stream, log, progress, _LOG)
    taken = spark.read.parquet(log)
    return sync.latest_per_chunk(sync.compact_log(taken, scratch_path(spark, "compacted"))).select(
        "chunk_id", "chunk_text", "vec_id", _shown("audit__updated_date"))
