"""Queries over sources, sinks, projections, filters, joins, aggregates and versions."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docloom.functions.filters import FlatFilter, TypeRule, UnitFilter
from docloom.functions.metadata import (
    align, composite_path, document_prefix, id_batch, iso_timestamp, landing_prefix, normalise_names, target_path,
)
from docloom.functions.text import explode_pages, html_to_text, page_array
from docloom.functions.text import keyword_tags as find_keywords
from docloom.operators import corpus, positions, stages, versions
from docloom.operators.chat import TITLE_KEYWORDS
from docloom.plans import fixtures as fx
from docloom.schemas import (
    BATCH_COUNT, COMPLETED, DEFAULTS, EXPORT_RENAMES, ISO_PATTERN, METADATA, STAGE_COLUMNS, VERSION_KEY,
)
from docloom.sources import readers, writers
from docloom.staging import scratch_path, spread, stage

QUERIES = {}
ORACLE = {}
SPLIT_BYTES = 1 << 19


def query(sql: str | None, *fixtures: str):
    def register(fn):
        QUERIES[fn.__name__] = fn
        if sql is not None:
            ORACLE[fn.__name__] = fx.oracle(sql, *fixtures)
        return fn

    return register


def scratch_database(spark: SparkSession) -> str:
    """A database of its own inside the scratch folder, so managed tables land there too."""
    name = f"docloom_{uuid.uuid4().hex[:12]}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{scratch_path(spark, 'db')}'")
    return name


# --- sources -------------------------------------------------------------------------------

@query("SELECT doc_id, lang, source, n_chars FROM documents")
def src_table_scan(spark, sf_dir):
    return readers.read_table(spark, f"{sf_dir}/documents.parquet").select("doc_id", "lang", "source", "n_chars")


@query("SELECT metadata_id, document_number FROM fx_meta WHERE download_status = 'PENDING'", "fx_meta")
def src_sql_gate(spark, sf_dir):
    text = "SELECT metadata_id, document_number FROM {m} WHERE download_status = 'PENDING'"
    return readers.scan_sql(spark, text, m=fx.metadata(spark, sf_dir))


@query("""SELECT document_id, document_number, document_title, size, status, document_major_version,
          is_latest_version, file_modified_date FROM fx_meta""", "fx_meta")
def src_csv_export(spark, sf_dir):
    written = fx.export(fx.metadata(spark, sf_dir))
    path = scratch_path(spark, "export")
    written.write.option("header", "true").option("escape", '"').csv(path)
    schema = T.StructType([T.StructField(n, T.StringType()) for n in written.columns])
    read = readers.read_export_csv(spark, path, schema)
    renamed = normalise_names(read).withColumnsRenamed(EXPORT_RENAMES)
    return align(renamed, METADATA).select(
        "document_id", "document_number", "document_title", "size", "status", "document_major_version",
        "is_latest_version", "file_modified_date",
    )


@query("SELECT doc_id, lang, text, CAST(strlen(text) AS BIGINT) AS bytes FROM documents")
def src_csv_quoted(spark, sf_dir):
    """Whole texts with line breaks, quotes and commas, through CSV files cut into many small splits."""
    path, size = scratch_path(spark, "quoted"), "spark.sql.files.maxPartitionBytes"
    written = fx.table(spark, sf_dir, "documents").select("doc_id", "lang", "text")
    written.write.options(header="true", escape='"', quoteAll="true", ignoreLeadingWhiteSpace="false",
                          ignoreTrailingWhiteSpace="false").csv(path)
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("lang", T.StringType()), T.StructField("text", T.StringType())])
    usual = spark.conf.get(size)
    spark.conf.set(size, str(SPLIT_BYTES))
    try:
        read = readers.read_quoted_csv(spark, path, schema)
    finally:
        spark.conf.set(size, usual)
    return read.select("doc_id", "lang", "text", F.octet_length("text").cast("long").alias("bytes"))


@query("""SELECT page_id, split_part(regexp_replace(uri, '^s3[an]?://', ''), '/', 1) AS bucket,
          regexp_replace(regexp_replace(uri, '^s3[an]?://', ''), '^[^/]*/', '') AS object_key
          FROM (SELECT page_id, concat(CASE WHEN page_id % 3 = 0 THEN 's3://' WHEN page_id % 3 = 1 THEN 's3a://'
                ELSE 's3n://' END, regexp_replace(url, '^https?://', '')) AS uri FROM pages)""")
def src_uri_parts(spark, sf_dir):
    scheme = F.when(F.col("page_id") % 3 == 0, "s3://").when(F.col("page_id") % 3 == 1, "s3a://").otherwise("s3n://")
    uri = F.concat(scheme, F.regexp_replace("url", "^https?://", ""))
    parts = readers.uri_parts(uri)
    return fx.table(spark, sf_dir, "pages").select("page_id", *[c.alias(n) for n, c in parts.items()])


def _pages_to_land(spark, sf_dir, root):
    path = F.concat(F.lit(f"{root}/batch_id="), id_batch(F.col("page_id"), BATCH_COUNT).cast("string"),
                    F.lit("/"), F.col("page_id").cast("string"), F.lit(".html"))
    return fx.table(spark, sf_dir, "pages").select(
        F.col("page_id").alias("metadata_id"),
        path.alias("document_s3_path"),
        F.when(F.col("url").contains("#"), "text/html").otherwise("application/octet-stream").alias("content_type"),
        "html",
    )


def _from_row(frame):
    for row in frame.itertuples():
        yield row.content_type, row.html.encode("utf-8")


@query("""SELECT page_id AS metadata_id, CASE WHEN contains(url, '#') THEN 'FAILED' ELSE 'COMPLETED' END AS status,
          CASE WHEN contains(url, '#') THEN 'content type text/html' END AS error FROM pages""")
def land_files(spark, sf_dir):
    landed = writers.land_files(_pages_to_land(spark, sf_dir, scratch_path(spark, "landing")), _from_row)
    return stage(landed, "download-status")


@query("SELECT page_id, CAST(strlen(html) AS BIGINT) AS length, sha256(html) AS digest FROM pages WHERE NOT contains(url, '#')")
def src_binary(spark, sf_dir):
    root = scratch_path(spark, "landing")
    stage(writers.land_files(_pages_to_land(spark, sf_dir, root), _from_row), "download-status")
    found = readers.read_binary(spark, root, "*.html")
    return found.select(F.regexp_extract("path", r"(\d+)\.html$", 1).cast("bigint").alias("page_id"), "length",
                        F.sha2("content", 256).alias("digest"))


# --- sinks and table definitions -----------------------------------------------------------

@query("SELECT metadata_id, download_status AS status FROM fx_meta", "fx_meta")
def sink_overwrite_roundtrip(spark, sf_dir):
    table = f"{scratch_database(spark)}.download_status"
    statuses = fx.metadata(spark, sf_dir).select("metadata_id", F.lit("PENDING").alias("status"))
    writers.overwrite_table(statuses, table)
    final = fx.metadata(spark, sf_dir).select("metadata_id", F.col("download_status").alias("status"))
    return writers.overwrite_table(final, table)


@query(r"""SELECT metadata_id, count(*) FILTER (WHERE n > 0) AS n_completed, count(*) AS n_total,
          CASE WHEN count(*) FILTER (WHERE n > 0) = count(*) THEN 'COMPLETED'
               WHEN count(*) FILTER (WHERE n > 0) > 0 THEN 'PARTIAL_SUCCESS' ELSE 'FAILED' END AS final_status
          FROM (SELECT metadata_id, len(regexp_extract_all(lower(chunk_text), '[\p{L}\p{N}]+')) AS n FROM fx_chunks)
          GROUP BY metadata_id""", "fx_chunks")
def sink_stage_once(spark, sf_dir):
    """The embedding runs once, into the staging table; vectors and the roll-up both read that."""
    slow = corpus.embed_hashing(fx.chunks(spark, sf_dir), 64)
    staged = writers.stage_table(slow, f"{scratch_database(spark)}.staging", scratch_path(spark, "staging"))
    return stages.status_rollup(staged)


@query("SELECT max(version_modified_date) AS incremental_date FROM fx_meta WHERE version_modified_date <> 'unknown'",
       "fx_meta")
def watermark_next(spark, sf_dir):
    path = scratch_path(spark, "watermark")
    writers.write_watermark(writers.next_watermark(fx.metadata(spark, sf_dir)), path)
    return writers.read_watermark(spark, path)


@query("""SELECT metadata_id, document_number, 'PENDING' AS download_status, 'PENDING' AS index_status,
          true AS is_latest_doc_in_dl, false AS undated FROM fx_meta""", "fx_meta")
def ddl_tables(spark, sf_dir):
    """Create every corpus table, insert some columns of the metadata, and read back the column defaults."""
    database = scratch_database(spark)
    writers.create_tables(spark, database)
    rows = fx.metadata(spark, sf_dir).select("metadata_id", "document_number")
    spark.sql(f"INSERT INTO {database}.docs_metadata (metadata_id, document_number) SELECT * FROM {{rows}}", rows=rows)
    return spark.table(f"{database}.docs_metadata").select(
        "metadata_id", "document_number", "download_status", "index_status", "is_latest_doc_in_dl",
        F.col("audit__created_date").isNull().alias("undated"),
    )


@query("""SELECT metadata_id, document_number, CASE WHEN metadata_id % 2 = 1 THEN 'PENDING' END AS index_status FROM fx_meta""",
       "fx_meta")
def ddl_evolve(spark, sf_dir):
    """A table from before some columns existed gets them, with defaults for rows that come later."""
    database = scratch_database(spark)
    spark.sql(f"CREATE TABLE {database}.docs_metadata (metadata_id BIGINT, document_number STRING) USING parquet")
    rows = fx.metadata(spark, sf_dir).select("metadata_id", "document_number")
    insert = f"INSERT INTO {database}.docs_metadata (metadata_id, document_number) SELECT * FROM {{rows}}"
    spark.sql(insert, rows=rows.filter("metadata_id % 2 = 0"))
    writers.create_tables(spark, database)
    spark.sql(insert, rows=rows.filter("metadata_id % 2 = 1"))
    return spark.table(f"{database}.docs_metadata").select("metadata_id", "document_number", "index_status")


@query("""SELECT b.document_number, b.document_id,
          (SELECT max(metadata_id) FROM fx_meta) + row_number() OVER (ORDER BY b.document_id) AS metadata_id
          FROM fx_batch b WHERE NOT EXISTS (SELECT 1 FROM fx_meta m WHERE m.document_number = b.document_number
            AND m.document_minor_version = b.document_minor_version
            AND m.document_major_version = b.document_major_version)""", "fx_batch")
def surrogate_keys(spark, sf_dir):
    known = fx.metadata(spark, sf_dir)
    new = fx.batch(spark, sf_dir).join(known.select(*VERSION_KEY), VERSION_KEY, "left_anti")
    rows = new.select("document_number", "document_id")
    return positions.surrogate_keys(rows, known, "metadata_id", [F.col("document_id")])


# --- projections ---------------------------------------------------------------------------

@query("""SELECT metadata_id, concat(CAST(document_id AS VARCHAR), '/', document_number) AS dst_path,
          'landing/2024_05_01_12_30_45' AS landing_prefix,
          concat('s3://corpus/landing/2024_05_01_12_30_45/batch_id=', CAST(document_id % 20 AS VARCHAR), '/',
            document_number, '.', list_last(string_split(source_file_path, '.'))) AS document_s3_path FROM fx_meta""",
       "fx_meta")
def meta_paths(spark, sf_dir):
    prefix = landing_prefix(F.lit(fx.NOW).cast("timestamp"))
    batch = id_batch(F.col("document_id"), BATCH_COUNT)
    return fx.metadata(spark, sf_dir).select(
        "metadata_id",
        composite_path(F.col("document_id").cast("string"), F.col("document_number")).alias("dst_path"),
        prefix.alias("landing_prefix"),
        target_path(F.concat(F.lit("s3://corpus/"), prefix), batch, F.col("document_number"),
                    F.col("source_file_path")).alias("document_s3_path"),
    )


@query("""SELECT source_file_path, rendition_type, CAST(document_id AS VARCHAR) AS document_id, document_name,
          CAST(size AS VARCHAR) AS size, status, document_title, document_type, document_subtype, doc_control_name,
          classification, CAST(document_major_version AS VARCHAR) AS document_major_version,
          CAST(document_minor_version AS VARCHAR) AS document_minor_version, document_number, owning_function_name,
          owning_site_name, CAST(is_latest_version AS VARCHAR) AS is_latest_version, file_modified_date,
          version_modified_date FROM fx_meta""", "fx_meta")
def meta_rename(spark, sf_dir):
    return normalise_names(fx.export(fx.metadata(spark, sf_dir))).withColumnsRenamed(EXPORT_RENAMES)


@query("SELECT document_id, document_id % 20 AS batch_id FROM fx_meta", "fx_meta")
def batch_assign(spark, sf_dir):
    return fx.metadata(spark, sf_dir).select("document_id", id_batch(F.col("document_id"), BATCH_COUNT).alias("batch_id"))


@query("""SELECT CASE WHEN doc_control_name = 'fr' THEN NULL ELSE size END AS size, document_number,
          document_major_version, is_latest_version, doc_control_name = 'fr' AS rejected, document_id FROM fx_meta""",
       "fx_meta")
def schema_align(spark, sf_dir):
    text = fx.metadata(spark, sf_dir).select(
        F.lit("x").alias("not_in_target"),
        F.col("is_latest_version").cast("string"),
        F.col("document_number"),
        F.when(F.col("doc_control_name") == "fr", "n/a").otherwise(F.col("size").cast("string")).alias("size"),
        F.col("document_id").cast("string"),
        F.col("document_major_version").cast("string"),
    )
    return align(text, METADATA, reject="rejected")


@query("""SELECT metadata_id, strftime(try_strptime(file_modified_date, '%Y-%m-%dT%H:%M:%S.%gZ'),
            '%Y-%m-%d %H:%M:%S.%g') AS file_modified,
          strftime(try_strptime(version_modified_date, '%Y-%m-%dT%H:%M:%S.%gZ'),
            '%Y-%m-%d %H:%M:%S.%g') AS version_modified FROM fx_meta""", "fx_meta")
def ts_parse(spark, sf_dir):
    show = "yyyy-MM-dd HH:mm:ss.SSS"
    return fx.metadata(spark, sf_dir).select(
        "metadata_id",
        F.date_format(iso_timestamp(F.col("file_modified_date"), ISO_PATTERN), show).alias("file_modified"),
        F.date_format(iso_timestamp(F.col("version_modified_date"), ISO_PATTERN), show).alias("version_modified"),
    )


@query("SELECT metadata_id, split_part(document_number, '-', 1) AS doc_prefix FROM fx_batch", "fx_batch")
def doc_prefix(spark, sf_dir):
    return fx.batch(spark, sf_dir).select("metadata_id", document_prefix(F.col("document_number")).alias("doc_prefix"))


# --- extraction, chunking, embedding -------------------------------------------------------

@query("SELECT metadata_id, page_number, page_text, total_pages, 'COMPLETED' AS extraction_status FROM fx_pages",
       "fx_pages")
def extract_text_pages(spark, sf_dir):
    pages = corpus.with_pages(fx.texts(spark, sf_dir), page_array(F.col("text")))
    return explode_pages(pages, "pdf_text", "metadata_id", "extraction_status").select(
        "metadata_id", "extraction_status", "_page.*")


_HTML_TEXT = r"""
trim(regexp_replace(regexp_replace(
  replace(replace(replace(replace(replace(replace(
    regexp_replace(regexp_replace(regexp_replace(html,
      '(?is)<script[^>]*>.*?</script>|<style[^>]*>.*?</style>|<!--.*?-->', ' ', 'g'),
      '(?is)</?(?:p|div|h[1-6]|li|ul|ol|br|tr|table|nav|article|title|head|body)(?:\s[^>]*)?/?>', chr(10), 'g'),
      '(?s)<[^>]+>', '', 'g'),
    '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', chr(39)), '&nbsp;', ' '), '&amp;', '&'),
  '[ \t]+', ' ', 'g'), ' ?\n[ \n]*', chr(10), 'g'), ' ' || chr(10))
"""


@query(f"""SELECT page_id, CAST(p + 1 AS INTEGER) AS page_number, substring(txt, p * 2000 + 1, 2000) AS page_text,
           CAST(ceil(length(txt) / 2000.0) AS INTEGER) AS total_pages
           FROM (SELECT *, unnest(range(0, CAST(ceil(length(txt) / 2000.0) AS BIGINT))) AS p
                 FROM (SELECT page_id, {_HTML_TEXT} AS txt FROM pages))""")
def extract_html_text(spark, sf_dir):
    raw = spread(fx.table(spark, sf_dir, "pages").select("page_id", "html"), "page_id")
    text = raw.select("page_id", html_to_text(F.col("html")).alias("text"))
    pages = text.select("page_id", page_array(F.col("text")).alias("pages"))
    return explode_pages(pages, "pages", "page_id").select("page_id", "_page.*")


@query("""SELECT metadata_id, 'FAILED' AS extraction_status, -1 AS page_number, 'Error: no content' AS page_text,
          -1 AS total_pages FROM fx_meta WHERE download_status <> 'COMPLETED'""", "fx_meta")
def extract_failures(spark, sf_dir):
    landed = fx.metadata(spark, sf_dir).select("metadata_id", "download_status")
    text = fx.texts(spark, sf_dir)
    content = F.when(F.col("download_status") == COMPLETED, F.col("text"))
    pages = corpus.with_pages(landed.join(text, "metadata_id"), page_array(content))
    failed = pages.filter(F.col("extraction_status") != COMPLETED)
    return explode_pages(failed, "pdf_text", "metadata_id", "extraction_status").select(
        "metadata_id", "extraction_status", "_page.*")


@query("""SELECT metadata_id, page_text AS chunk_text, page_number AS document_page_number,
          total_pages AS document_total_pages, 'COMPLETED' AS chunking_status, true AS no_vector,
          CAST(NULL AS VARCHAR) AS embedding_status FROM fx_pages""", "fx_pages")
def chunk_explode(spark, sf_dir):
    rows = corpus.chunk_pages(fx.page_documents(spark, sf_dir))
    return rows.withColumn("no_vector", F.col("embedding").isNull()).drop("embedding")


@query("""SELECT metadata_id, CASE WHEN download_status = 'COMPLETED' THEN CAST(ceil(size / 2000.0) AS BIGINT)
          ELSE 0 END AS n_chunks, CASE WHEN download_status = 'COMPLETED' THEN 'COMPLETED' ELSE 'FAILED' END
          AS chunking_status FROM fx_meta""", "fx_meta")
def chunk_zero_pages(spark, sf_dir):
    state = fx.metadata(spark, sf_dir).select("metadata_id", "download_status")
    none = F.array().cast(T.ArrayType(fx.page_documents(spark, sf_dir).schema["pdf_text"].dataType.elementType))
    found = (
        F.when(F.col("download_status") == COMPLETED, F.col("pdf_text"))
        .when(F.col("download_status") == "PENDING", none)
    )
    documents = fx.page_documents(spark, sf_dir).join(state, "metadata_id").withColumn("pdf_text", found)
    return corpus.chunk_outcome(documents)


@query("""SELECT chunk_id, metadata_id, embedding_status,
          CAST(CASE WHEN embedding_status = 'COMPLETED' THEN 64 ELSE 0 END AS INTEGER) AS dimensions FROM fx_chunks""",
       "fx_chunks")
def embed_status(spark, sf_dir):
    embedded = corpus.embed_from_vectors(fx.chunks(spark, sf_dir), fx.table(spark, sf_dir, "embeddings"), "vec_id")
    return embedded.select("chunk_id", "metadata_id", "embedding_status", F.size("embedding").alias("dimensions"))


@query(r"""SELECT chunk_id, metadata_id, CASE WHEN n > 0 THEN 'COMPLETED' ELSE 'FAILED' END AS embedding_status,
           CASE WHEN n > 0 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS norm
           FROM (SELECT *, len(regexp_extract_all(lower(chunk_text), '[\p{L}\p{N}]+')) AS n FROM fx_chunks)""",
       "fx_chunks")
def embed_hashing(spark, sf_dir):
    embedded = corpus.embed_hashing(fx.chunks(spark, sf_dir), 256)
    squares = F.aggregate("embedding", F.lit(0.0), lambda acc, x: acc + x.cast("double") * x)
    return embedded.select("chunk_id", "metadata_id", "embedding_status", F.round(F.sqrt(squares), 3).alias("norm"))


@query("""WITH found AS (SELECT m.metadata_id, regexp_extract_all(concat(m.document_title, ' ', d.text),
            'TM-|SOP|GMP|KG') AS tags FROM fx_meta m JOIN documents d ON d.doc_id = m.metadata_id),
          placed AS (SELECT metadata_id, unnest(tags) AS tag, unnest(range(len(tags))) AS place FROM found),
          firsts AS (SELECT metadata_id, tag, min(place) AS place FROM placed GROUP BY metadata_id, tag),
          joined AS (SELECT metadata_id, string_agg(tag, ',' ORDER BY place) AS tags FROM firsts GROUP BY metadata_id)
          SELECT metadata_id, coalesce(j.tags, '') AS tags FROM found LEFT JOIN joined j USING (metadata_id)""",
       "fx_meta")
def keyword_tags(spark, sf_dir):
    titles = fx.metadata(spark, sf_dir).select("metadata_id", "document_title")
    text = fx.texts(spark, sf_dir)
    body = F.concat_ws(" ", "document_title", "text")
    return titles.join(text, "metadata_id").select(
        "metadata_id", F.array_join(find_keywords(body, TITLE_KEYWORDS), ",").alias("tags")
    )


# --- filters, joins, aggregates ------------------------------------------------------------

@query("""SELECT 'download' AS stage, metadata_id FROM fx_meta WHERE download_status = 'PENDING'
          UNION ALL SELECT 'extraction', metadata_id FROM fx_meta
            WHERE extraction_status = 'PENDING' AND download_status = 'COMPLETED'
          UNION ALL SELECT 'chunking', metadata_id FROM fx_meta
            WHERE chunking_status = 'PENDING' AND extraction_status = 'COMPLETED'
          UNION ALL SELECT 'embedding', metadata_id FROM fx_meta
            WHERE embedding_status = 'PENDING' AND chunking_status = 'COMPLETED'
          UNION ALL SELECT 'index', metadata_id FROM fx_meta
            WHERE index_status = 'PENDING' AND embedding_status IN ('COMPLETED', 'PARTIAL_SUCCESS')""", "fx_meta")
def stage_gates(spark, sf_dir):
    return stages.gate_report(fx.metadata(spark, sf_dir))


FLAT = FlatFilter(
    numbers=("DOC-00001", "DOC-00003", "DOC-00010", "O'Brien-1"),
    units=("en", "fr"),
    types=(TypeRule("src1"), TypeRule("src2", ("Policy", "Report")), TypeRule("src9", ("Procedure",)),
           TypeRule("src10"), TypeRule("src12")),
    statuses=("Approved", "Effective"),
)
NESTED = UnitFilter(
    units={
        "en": (TypeRule("src1", ("Procedure", "Policy")), TypeRule("src5", ("Report",)), TypeRule("src7", ("Policy",))),
        "fr": (TypeRule("src3", ("Procedure", "Report")),),
        "de": (TypeRule("src8", ("Policy", "Procedure", "Report")),),
    },
    statuses=("Approved", "Effective"),
)


@query("""SELECT metadata_id, document_number, document_type, document_subtype, status FROM fx_meta
          WHERE document_number IN ('DOC-00001', 'DOC-00003', 'DOC-00010', 'O''Brien-1')
            AND doc_control_name IN ('en', 'fr')
            AND (document_type = 'src1' OR (document_type = 'src2' AND document_subtype IN ('Policy', 'Report'))
              OR (document_type = 'src9' AND document_subtype IN ('Procedure')) OR document_type = 'src10'
              OR document_type = 'src12')
            AND status IN ('Approved', 'Effective')""", "fx_meta")
def filter_spec_flat(spark, sf_dir):
    return fx.metadata(spark, sf_dir).filter(FLAT.predicate()).select(
        "metadata_id", "document_number", "document_type", "document_subtype", "status")


@query("""SELECT metadata_id, document_number, doc_control_name FROM fx_meta WHERE (
            (doc_control_name = 'en' AND document_type = 'src1' AND document_subtype IN ('Procedure', 'Policy'))
            OR (doc_control_name = 'en' AND document_type = 'src5' AND document_subtype IN ('Report'))
            OR (doc_control_name = 'en' AND document_type = 'src7' AND document_subtype IN ('Policy'))
            OR (doc_control_name = 'fr' AND document_type = 'src3' AND document_subtype IN ('Procedure', 'Report'))
            OR (doc_control_name = 'de' AND document_type = 'src8' AND
                document_subtype IN ('Policy', 'Procedure', 'Report')))
          AND status IN ('Approved', 'Effective')""", "fx_meta")
def filter_spec_nested(spark, sf_dir):
    return fx.metadata(spark, sf_dir).filter(NESTED.predicate()).select(
        "metadata_id", "document_number", "doc_control_name")


SLICE = 50


@query(f"""SELECT slice_no, count(*) AS n_ids, string_agg(document_number, ',' ORDER BY document_number) AS ids
          FROM (SELECT document_number, CAST(floor((row_number() OVER (ORDER BY document_number) - 1) / {SLICE})
                AS BIGINT) AS slice_no FROM (SELECT DISTINCT document_number FROM fx_meta)) GROUP BY slice_no""",
       "fx_meta")
def id_slices(spark, sf_dir):
    slices = positions.id_slices(fx.metadata(spark, sf_dir), "document_number", SLICE)
    return slices.select(
        "slice_no", F.size("ids").cast("bigint").alias("n_ids"), F.array_join("ids", ",").alias("ids"))


@query("""SELECT chunk_id, metadata_id, chunk_text FROM fx_chunks WHERE metadata_id IN (
          SELECT metadata_id FROM fx_meta WHERE embedding_status = 'PENDING' AND chunking_status = 'COMPLETED')""",
       "fx_chunks", "fx_meta")
def semi_join(spark, sf_dir):
    batch = stages.gated(fx.metadata(spark, sf_dir), "embedding")
    return stages.in_batch(fx.chunks(spark, sf_dir).select("chunk_id", "metadata_id", "chunk_text"), batch)


@query("""SELECT metadata_id, c AS n_completed, n AS n_total, CASE WHEN c = n THEN 'COMPLETED' WHEN c > 0
          THEN 'PARTIAL_SUCCESS' ELSE 'FAILED' END AS final_status FROM (
            SELECT metadata_id, count(CASE WHEN embedding_status = 'COMPLETED' THEN 1 END) AS c, count(*) AS n
            FROM fx_chunks GROUP BY metadata_id)""", "fx_chunks")
def status_rollup(spark, sf_dir):
    return stages.status_rollup(fx.chunks(spark, sf_dir))


@query("SELECT DISTINCT metadata_id, embedding_status FROM fx_chunks", "fx_chunks")
def distinct_status(spark, sf_dir):
    return stages.distinct_status(fx.chunks(spark, sf_dir), "embedding_status")


@query("""SELECT download_status, extraction_status, chunking_status, embedding_status, index_status,
          count(*) AS documents FROM fx_meta GROUP BY ALL""", "fx_meta")
def stage_funnel(spark, sf_dir):
    return stages.funnel(fx.metadata(spark, sf_dir))


# --- versions ------------------------------------------------------------------------------

@query("""SELECT metadata_id, document_number, CAST(rank() OVER (PARTITION BY document_number
          ORDER BY document_major_version DESC NULLS LAST, document_minor_version DESC NULLS LAST) AS INTEGER)
          AS version_rank FROM fx_meta""", "fx_meta")
def version_rank(spark, sf_dir):
    rows = fx.metadata(spark, sf_dir).select(
        "metadata_id", "document_number", "document_major_version", "document_minor_version")
    return versions.version_rank(rows).select("metadata_id", "document_number", "version_rank")


@query("""SELECT metadata_id FROM (SELECT metadata_id, rank() OVER (PARTITION BY document_number
          ORDER BY document_major_version DESC, document_minor_version DESC) AS r FROM fx_meta) WHERE r > 1""",
       "fx_meta")
def version_superseded(spark, sf_dir):
    return versions.superseded(fx.metadata(spark, sf_dir))
