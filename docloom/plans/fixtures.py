"""Corpus tables derived from the given Parquet tables, with the same rows in Spark and in DuckDB.

``FX`` holds DuckDB text for each; the frames below build the same rows in Spark.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom.functions.text import PAGE_CHARS, explode_pages, page_array
from docloom.schemas import COMPLETED, EXPORT_FIELDS, EXPORT_RENAMES, FAILED
from docloom.staging import spread

# Runs unchanged in both engines; {documents} is the table.
METADATA_SQL = """
SELECT doc_id AS metadata_id,
  concat('/stage/', CAST(doc_id AS STRING), CASE WHEN doc_id % 50 = 0 THEN '' ELSE '.pdf' END) AS source_file_path,
  CASE WHEN doc_id % 5 = 0 THEN 'source' ELSE 'viewable_rendition__v' END AS rendition_type,
  100000 + doc_id AS document_id,
  concat('Document ', CAST(doc_id AS STRING)) AS document_name,
  n_chars AS size,
  CASE WHEN doc_id % 10 < 6 THEN 'Approved' WHEN doc_id % 10 < 9 THEN 'Effective' ELSE 'Draft' END AS status,
  concat(CASE WHEN doc_id % 5 = 0 THEN 'SOP on ' WHEN doc_id % 5 = 1 THEN 'TM-12 and KG of '
    WHEN doc_id % 5 = 2 THEN 'GMP ' ELSE '' END, 'Document ', CAST(doc_id AS STRING)) AS document_title,
  source AS document_type,
  CASE WHEN doc_id % 4 = 0 THEN 'Policy' WHEN doc_id % 4 = 1 THEN 'Procedure' ELSE 'Report' END AS document_subtype,
  lang AS doc_control_name,
  CASE WHEN doc_id % 6 = 0 THEN 'Restricted' ELSE 'Internal' END AS classification,
  doc_id % 3 AS document_major_version,
  doc_id % 2 AS document_minor_version,
  concat('DOC-', lpad(CAST(CAST(floor(doc_id / 8) AS BIGINT) AS STRING), 5, '0')) AS document_number,
  concat('Function ', CAST(doc_id % 4 AS STRING)) AS owning_function_name,
  concat('Site ', CAST(doc_id % 9 AS STRING)) AS owning_site_name,
  doc_id % 3 = 2 AS is_latest_version,
  concat('2023-', lpad(CAST(1 + doc_id % 12 AS STRING), 2, '0'), '-', lpad(CAST(1 + doc_id % 28 AS STRING), 2, '0'),
    'T', lpad(CAST(doc_id % 24 AS STRING), 2, '0'), ':05:09.', lpad(CAST(doc_id % 1000 AS STRING), 3, '0'), 'Z')
    AS file_modified_date,
  CASE WHEN doc_id % 17 = 0 THEN 'unknown' ELSE
    concat('2024-', lpad(CAST(1 + doc_id % 11 AS STRING), 2, '0'), '-', lpad(CAST(1 + doc_id % 27 AS STRING), 2, '0'),
    'T10:', lpad(CAST(doc_id % 60 AS STRING), 2, '0'), ':30.', lpad(CAST(doc_id % 997 AS STRING), 3, '0'), 'Z') END
    AS version_modified_date,
  CASE WHEN doc_id % 7 = 0 THEN 'PENDING' WHEN doc_id % 11 = 0 THEN 'FAILED' ELSE 'COMPLETED' END AS download_status,
  CASE WHEN doc_id % 7 = 0 OR doc_id % 11 = 0 OR doc_id % 9 = 0 THEN 'PENDING'
    WHEN doc_id % 23 = 0 THEN 'FAILED' ELSE 'COMPLETED' END AS extraction_status,
  CASE WHEN doc_id % 7 = 0 OR doc_id % 11 = 0 OR doc_id % 9 = 0 OR doc_id % 23 = 0 OR doc_id % 8 = 0 THEN 'PENDING'
    ELSE 'COMPLETED' END AS chunking_status,
  CASE WHEN doc_id % 7 = 0 OR doc_id % 11 = 0 OR doc_id % 9 = 0 OR doc_id % 23 = 0 OR doc_id % 8 = 0
    OR doc_id % 6 = 1 THEN 'PENDING' WHEN doc_id % 13 = 0 THEN 'FAILED'
    WHEN doc_id % 3 = 0 THEN 'PARTIAL_SUCCESS' ELSE 'COMPLETED' END AS embedding_status,
  CASE WHEN doc_id % 5 = 2 AND doc_id % 7 <> 0 AND doc_id % 11 <> 0 AND doc_id % 9 <> 0 AND doc_id % 23 <> 0
    AND doc_id % 8 <> 0 AND doc_id % 6 <> 1 AND doc_id % 13 <> 0 THEN 'COMPLETED' ELSE 'PENDING' END AS index_status
FROM {documents}
"""

# A later export of every document: English ones again under their key, the others under new keys.
BATCH_SQL = """
SELECT CASE WHEN doc_control_name = 'en' THEN metadata_id ELSE metadata_id + 1000000 END AS metadata_id,
  source_file_path, rendition_type, document_id + 500000 AS document_id, document_name, size, status,
  concat(document_title, ' (revised)') AS document_title, document_type, document_subtype, doc_control_name,
  CASE WHEN doc_control_name = 'en' THEN document_number ELSE concat('NEW-', document_number) END AS document_number,
  document_major_version, document_minor_version
FROM {metadata}
"""

EARLIER, LATER, NOW = "2024-03-01 00:00:00", "2024-04-01 00:00:00", "2024-05-01 12:30:45"


def _pages_cte(size: str) -> str:
    return f"""
SELECT doc_id AS metadata_id, lang, CAST(p + 1 AS INTEGER) AS page_number,
  substring(text, CAST(p * size + 1 AS BIGINT), size) AS page_text,
  CAST(ceil(n_chars / CAST(size AS DOUBLE)) AS INTEGER) AS total_pages
FROM (SELECT *, unnest(range(0, CAST(ceil(n_chars / CAST(size AS DOUBLE)) AS BIGINT))) AS p
      FROM (SELECT *, {size} AS size FROM documents))"""


def _chunks_cte(pages: str) -> str:
    return f"""
SELECT metadata_id * 1000 + page_number AS chunk_id, metadata_id, lang, page_text AS chunk_text,
  page_number AS document_page_number, total_pages AS document_total_pages,
  CASE WHEN metadata_id % 13 = 0 OR page_number % 3 = 0 THEN 'FAILED' ELSE 'COMPLETED' END AS embedding_status,
  CASE WHEN NOT (metadata_id % 13 = 0 OR page_number % 3 = 0)
    THEN (metadata_id * 31 + page_number * 37) % (SELECT count(*) FROM embeddings) END AS vec_id
FROM {pages}"""


FX = {
    "fx_meta": METADATA_SQL.replace("{documents}", "documents"),
    "fx_batch": BATCH_SQL.replace("{metadata}", "fx_meta"),
    "fx_pages": _pages_cte(str(PAGE_CHARS)),
    "fx_pages_before": _pages_cte("CASE WHEN lang = 'en' THEN 3000 ELSE 2000 END"),
    "fx_pages_after": _pages_cte("CASE WHEN lang = 'en' THEN 2000 ELSE 3000 END"),
    "fx_chunks": _chunks_cte("fx_pages"),
    "fx_chunks_before": _chunks_cte("fx_pages_before"),
    "fx_chunks_after": _chunks_cte("fx_pages_after"),
    "fx_questions": """
SELECT conv_id AS question_id, arg_max(text, turn) AS text,
  conv_id % (SELECT count(*) FROM embeddings) AS vec_id FROM conversations GROUP BY conv_id""",
}
_NEEDS = {
    "fx_batch": ["fx_meta"],
    "fx_chunks": ["fx_pages"],
    "fx_chunks_before": ["fx_pages_before"],
    "fx_chunks_after": ["fx_pages_after"],
}


def oracle(query: str, *fixtures: str) -> str:
    """DuckDB text of a query over fixtures, whose definitions come first."""
    ordered: list[str] = []
    for name in fixtures:
        ordered += [n for n in [*_NEEDS.get(name, []), name] if n not in ordered]
    if not ordered:
        return query.strip()
    body = query.strip()
    ctes = ",\n".join(f"{n} AS ({FX[n].strip()})" for n in ordered)
    if body.upper().startswith("WITH "):
        return f"WITH {ctes},\n{body[5:]}"
    return f"WITH {ctes}\n{body}"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(METADATA_SQL, documents=table(spark, sf_dir, "documents"))


def batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(BATCH_SQL, metadata=metadata(spark, sf_dir))


def export(meta: DataFrame) -> DataFrame:
    """Metadata under the names, and as the text, of an export file."""
    back = {v: k for k, v in EXPORT_RENAMES.items()}
    written = {f.replace(".", "_").removesuffix("__v"): f for f in EXPORT_FIELDS}
    columns = [
        F.col(c).cast("string").alias(written[back[c]])
        for c in meta.columns
        if c in back and back[c] in written
    ]
    return meta.select(*columns)


def texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("metadata_id"), "lang", "text")
    return spread(documents, "metadata_id")


BEFORE, AFTER = (3000, 2000), (2000, 3000)


def page_documents(spark: SparkSession, sf_dir: str, sizes: tuple[int, int] = (PAGE_CHARS, PAGE_CHARS)) -> DataFrame:
    """One row per document with its page array; page sizes are for English and for other documents."""
    english, other = (page_array(F.col("text"), size) for size in sizes)
    pages = english if sizes[0] == sizes[1] else F.when(F.col("lang") == "en", english).otherwise(other)
    return texts(spark, sf_dir).select("metadata_id", "lang", pages.alias("pdf_text"))


def failed_chunk() -> Column:
    return (F.col("metadata_id") % 13 == 0) | (F.col("document_page_number") % 3 == 0)


def chunks(spark: SparkSession, sf_dir: str, sizes: tuple[int, int] = (PAGE_CHARS, PAGE_CHARS)) -> DataFrame:
    """Chunk rows with a simulated embedding outcome and the number of their vector."""
    n_vectors = table(spark, sf_dir, "embeddings").agg(F.count(F.lit(1))).scalar()
    rows = explode_pages(page_documents(spark, sf_dir, sizes), "pdf_text", "metadata_id", "lang").select(
        (F.col("metadata_id") * 1000 + F.col("_page.page_number")).alias("chunk_id"),
        "metadata_id",
        "lang",
        F.col("_page.page_text").alias("chunk_text"),
        F.col("_page.page_number").alias("document_page_number"),
        F.col("_page.total_pages").alias("document_total_pages"),
    )
    vector = (F.col("metadata_id") * 31 + F.col("document_page_number") * 37) % n_vectors
    return rows.withColumns({
        "embedding_status": F.when(failed_chunk(), FAILED).otherwise(COMPLETED),
        "vec_id": F.when(~failed_chunk(), vector),
    })


def chunks_with_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return chunks(spark, sf_dir).join(vectors, "vec_id", "left")


def questions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last message of every conversation, with a vector standing in for its embedding."""
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", F.col("embedding").alias("vector"))
    n_vectors = table(spark, sf_dir, "embeddings").agg(F.count(F.lit(1))).scalar()
    asked = (
        table(spark, sf_dir, "conversations")
        .groupBy(F.col("conv_id").alias("question_id"))
        .agg(F.max_by("text", "turn").alias("text"))
        .withColumn("vec_id", F.col("question_id") % n_vectors)
    )
    return asked.join(vectors, "vec_id").drop("vec_id")
