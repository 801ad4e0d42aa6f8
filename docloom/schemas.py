"""Table schemas, column defaults, export field names and the stage table."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

PENDING, COMPLETED, FAILED, PARTIAL = "PENDING", "COMPLETED", "FAILED", "PARTIAL_SUCCESS"

PAGE = T.StructType([
    T.StructField("page_number", T.IntegerType()),
    T.StructField("page_text", T.StringType()),
    T.StructField("total_pages", T.IntegerType()),
])

_LONG, _INT, _TEXT, _FLAG, _TIME = (
    T.LongType(), T.IntegerType(), T.StringType(), T.BooleanType(), T.TimestampType())
_VECTOR = T.ArrayType(T.FloatType())


def _schema(*columns: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns])


_AUDIT = (("audit__created_date", _TIME), ("audit__updated_date", _TIME))

# Column names and types of the corpus tables.
METADATA = _schema(
    ("metadata_id", _LONG),
    ("source_file_path", _TEXT),
    ("rendition_type", _TEXT),
    ("document_id", _LONG),
    ("document_name", _TEXT),
    ("size", _LONG),
    ("status", _TEXT),
    ("document_title", _TEXT),
    ("document_type", _TEXT),
    ("document_subtype", _TEXT),
    ("doc_control_name", _TEXT),
    ("doc_control_unit_id", _TEXT),
    ("classification", _TEXT),
    ("document_major_version", _LONG),
    ("document_minor_version", _LONG),
    ("lifecycle", _TEXT),
    ("effective_date", _TEXT),
    ("product", _TEXT),
    ("product_name", _TEXT),
    ("document_number", _TEXT),
    ("owning_function_name", _TEXT),
    ("owning_site_name", _TEXT),
    ("is_latest_version", _FLAG),
    ("file_modified_date", _TEXT),
    ("version_modified_date", _TEXT),
    ("pages", _LONG),
    ("dst_path", _TEXT),
    ("batch_id", _LONG),
    ("document_s3_path", _TEXT),
    ("extraction_status", _TEXT),
    ("chunking_status", _TEXT),
    ("embedding_status", _TEXT),
    ("index_status", _TEXT),
    ("download_status", _TEXT),
    *_AUDIT,
    ("is_latest_doc_in_dl", _FLAG),
)
PAGES = _schema(
    ("metadata_id", _LONG),
    ("document_s3_path", _TEXT),
    ("pdf_text", T.ArrayType(PAGE)),
    ("extraction_status", _TEXT),
    *_AUDIT,
)
CHUNKS = _schema(
    ("chunk_id", _LONG),
    ("metadata_id", _LONG),
    ("chunk_text", _TEXT),
    ("document_page_number", _INT),
    ("document_total_pages", _INT),
    ("chunking_status", _TEXT),
    ("embedding", _VECTOR),
    ("embedding_status", _TEXT),
    *_AUDIT,
)
SYNC = _schema(
    ("chunk_id", _LONG),
    ("document_number", _TEXT),
    ("document_s3_path", _TEXT),
    ("chunk_text", _TEXT),
    ("embedding", _VECTOR),
    ("document_total_pages", _INT),
    ("document_page_number", _INT),
    ("document_title", _TEXT),
    ("document_type", _TEXT),
    ("document_subtype", _TEXT),
    ("document_name", _TEXT),
    ("classification", _TEXT),
    ("document_id", _LONG),
    ("document_status", _TEXT),
    ("doc_control_name", _TEXT),
    ("document_major_version", _LONG),
    ("document_minor_version", _LONG),
    ("owning_function_name", _TEXT),
    ("owning_site_name", _TEXT),
    ("is_latest_version", _FLAG),
    ("file_modified_date", _TIME),
    ("version_modified_date", _TIME),
    *_AUDIT,
)
DOWNLOAD_STATUS = _schema(("metadata_id", _LONG), ("status", _TEXT))

TABLES = {
    "docs_metadata": METADATA,
    "docs_pages": PAGES,
    "docs_embeddings": CHUNKS,
    "docs_embeddings_sync": SYNC,
    "download_status": DOWNLOAD_STATUS,
}

# Tables that stages join on metadata_id.
BUCKETED = ("docs_metadata", "docs_pages", "docs_embeddings")

# Column defaults as SQL text; also applied by merges to the columns an insert omits.
_NOW = "current_timestamp()"
_AUDIT_DEFAULTS = {"audit__created_date": _NOW, "audit__updated_date": _NOW}
DEFAULTS: dict[str, dict[str, str]] = {
    "docs_metadata": {
        "extraction_status": "'PENDING'",
        "chunking_status": "'PENDING'",
        "embedding_status": "'PENDING'",
        "index_status": "'PENDING'",
        "download_status": "'PENDING'",
        "is_latest_doc_in_dl": "true",
        **_AUDIT_DEFAULTS,
    },
    "docs_pages": _AUDIT_DEFAULTS,
    "docs_embeddings": _AUDIT_DEFAULTS,
    "docs_embeddings_sync": _AUDIT_DEFAULTS,
    "download_status": {},
}

# Natural key of a document version.
VERSION_KEY = ["document_number", "document_minor_version", "document_major_version"]

# Field names of the metadata export and the names they get.
EXPORT_FIELDS = [
    "file", "rendition_type", "id", "name__v", "size__v", "status__v", "title__v", "type__v", "subtype__v",
    "doc_control_unit__c.name__v", "doc_control_unit__c", "classification__v", "major_version_number__v",
    "minor_version_number__v", "lifecycle__v", "approved_date__c", "final_date__c", "effective_date__v",
    "product__v", "product__v.name__v", "subcategory__c.name__v", "document_number__v",
    "owning_function__c.name__v", "owning_site__c.name__v", "latest_version__v", "file_modified_date__v",
    "version_modified_date__v", "pages__v",
]
EXPORT_RENAMES = {
    "file": "source_file_path",
    "rendition_type": "rendition_type",
    "id": "document_id",
    "name": "document_name",
    "size": "size",
    "status": "status",
    "title": "document_title",
    "type": "document_type",
    "subtype": "document_subtype",
    "doc_control_unit__c_name": "doc_control_name",
    "doc_control_unit__c": "doc_control_unit_id",
    "classification": "classification",
    "major_version_number": "document_major_version",
    "minor_version_number": "document_minor_version",
    "lifecycle": "lifecycle",
    "effective_date": "effective_date",
    "product": "product",
    "product__v_name": "product_name",
    "document_number": "document_number",
    "owning_function__c_name": "owning_function_name",
    "owning_site__c_name": "owning_site_name",
    "latest_version": "is_latest_version",
    "file_modified_date": "file_modified_date",
    "version_modified_date": "version_modified_date",
    "pages": "pages",
    "dst_path": "dst_path",
    "batch_id": "batch_id",
}
VIEWABLE_RENDITION = "viewable_rendition__v"
ISO_PATTERN = "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"
BATCH_COUNT = 20
IDS_PER_REQUEST = 3000

# Every field arrives as text: one bad value must not fail or null a whole file.
# The alignment step casts, and reports what does not cast.
EXPORT_SCHEMA = T.StructType([T.StructField(name, T.StringType()) for name in EXPORT_FIELDS])


@dataclass(frozen=True)
class Stage:
    """One step of the document life cycle: its status column and what lets a document in."""

    name: str
    column: str
    previous: str | None
    accepts: tuple[str, ...] = (COMPLETED,)


STAGES = (
    Stage("download", "download_status", None),
    Stage("extraction", "extraction_status", "download_status"),
    Stage("chunking", "chunking_status", "extraction_status"),
    Stage("embedding", "embedding_status", "chunking_status"),
    Stage("index", "index_status", "embedding_status", (COMPLETED, PARTIAL)),
)
STAGE_COLUMNS = [s.column for s in STAGES]
