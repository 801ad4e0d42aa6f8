"""The life-cycle jobs over catalog tables: load, download, extract, chunk, embed, index.

Each job freezes its gated batch, does its slow work once into a staging path, publishes its
table, and writes the document status last: a crash in between repeats work but loses none.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docloom.functions.metadata import align, batch_number, composite_path, normalise_names, target_path
from docloom.operators import corpus, stages, sync, versions
from docloom.operators.merge import Insert, Update, merge, publish, replace_by_key, update_column
from docloom.operators.positions import PAGE_BITS, chunk_key, spread_by_weight, surrogate_keys
from docloom.schemas import (
    BATCH_COUNT, BUCKETED, DEFAULTS, DOWNLOAD_STATUS, EXPORT_RENAMES, METADATA, TABLES, VERSION_KEY, VIEWABLE_RENDITION,
)
from docloom.sources.generations import VersionedTable, ranged
from docloom.sources.readers import CORRUPT
from docloom.sources.writers import Fetcher, create_tables, land_files, land_missing
from docloom.staging import scratch_root, stage


@dataclass(frozen=True)
class Corpus:
    """The tables of one corpus, and how jobs write them.

    Without ``part_width`` they are catalog tables and every write is a whole new table, which lets ``buckets`` spare
    the shuffles of joins. With it, ``part_width`` neighbouring document ids make a part, tables keep their
    versions under ``root``, and a write touches only the parts of its batch: the choice for large tables.
    """

    spark: SparkSession
    database: str
    root: str | None = None
    buckets: int | None = None
    as_of: Column | None = None
    part_width: int | None = None

    def create(self) -> None:
        if self.part_width is None:
            create_tables(self.spark, self.database, self.root, self.buckets)
        else:
            for table in TABLES:
                self.versioned(table).create()

    def versioned(self, table: str) -> VersionedTable:
        path = f"{(self.root or scratch_root(self.spark)).rstrip('/')}/{self.database}/{table}"
        document = f"shiftright(chunk_id, {PAGE_BITS})" if "metadata_id" not in TABLES[table].names else "metadata_id"
        return VersionedTable(self.spark, path, TABLES[table], ranged(document, self.part_width))

    def read(self, table: str) -> DataFrame:
        return self.spark.table(f"{self.database}.{table}") if self.part_width is None else self.versioned(table).read()

    def write(self, df: DataFrame, table: str) -> None:
        if self.part_width is not None:
            self.versioned(table).publish(df)
            return
        bucket = (self.buckets, "metadata_id") if self.buckets and table in BUCKETED else None
        publish(df, f"{self.database}.{table}", self.root, bucket)

    def update(self, table: str, batch: DataFrame, change: Callable[[DataFrame], DataFrame]) -> None:
        """Publish ``change(rows)``. It gets all rows that the keys of ``batch`` can touch, and maybe others, which it keeps."""
        if self.part_width is None:
            self.write(change(self.read(table)), table)
            return
        versioned = self.versioned(table)
        parts = versioned.touched(batch)
        if parts:
            versioned.publish(change(versioned.read(parts=parts)), parts)

    @property
    def now(self) -> Column:
        return F.current_timestamp() if self.as_of is None else self.as_of

    def write_status(self, statuses: DataFrame, column: str, value: str | None = None) -> None:
        statuses = stage(statuses, "statuses")
        self.update("docs_metadata", statuses, lambda known: update_column(known, statuses, "metadata_id", column, value, self.now))

    def batch(self, stage_name: str, *columns: str) -> DataFrame:
        return stage(stages.gated(self.read("docs_metadata"), stage_name, *columns), f"{stage_name}-batch")


def split_export(export: DataFrame, landing: str, batches: int = BATCH_COUNT) -> tuple[DataFrame, DataFrame]:
    """An export under its own field names, as (metadata rows with their paths and batch, rejects). A reject keeps its export row as JSON and says why.

    Rejected are lines that could not be read, rows without a full version key, and rows with a value that
    does not fit its column; none of them can be matched again, so loading them would add them every time.
    """
    path = composite_path(F.col("id").cast("string"), F.col("document_number__v"))
    corrupt = F.col(CORRUPT) if CORRUPT in export.columns else F.lit(None).cast("string")
    kept = export.withColumns({"_row": F.to_json(F.struct(*[F.col(f"`{c}`") for c in export.columns if c != CORRUPT])), "_corrupt": corrupt})
    renamed = normalise_names(kept.drop(CORRUPT).withColumn("dst_path", path)).withColumnsRenamed(EXPORT_RENAMES)
    renamed = renamed.withColumn("batch_id", batch_number(F.col("document_id"), batches))
    place = target_path(F.lit(landing), F.col("batch_id"), F.col("document_number"), F.col("source_file_path"))
    carried = T.StructType([*METADATA, T.StructField("_row", T.StringType()), T.StructField("_corrupt", T.StringType())])
    shaped = align(renamed.withColumn("document_s3_path", place), carried, reject="_lost")
    keyless = F.lit(False)
    for column in VERSION_KEY:
        keyless = keyless | F.col(column).isNull()
    reason = (F.when(F.col("_corrupt").isNotNull(), "unreadable line").when(F.col("_lost"), "value of another type")
              .when(keyless, "no version key"))
    judged = stage(shaped.withColumn("reason", reason), "export")
    bad = judged.filter("reason IS NOT NULL").select("reason", F.coalesce("_corrupt", "_row").alias("row"))
    return judged.filter("reason IS NULL").drop("_row", "_corrupt", "_lost", "reason"), bad


def keep_rejects(bad: DataFrame, path: str) -> None:
    """Append rejects to the table at ``path``; those already there are not added again."""
    spark, bad = bad.sparkSession, bad.distinct()
    empty = spark.createDataFrame([], bad.schema)
    empty.write.mode("append").parquet(path)
    known = spark.read.schema(bad.schema).parquet(path)
    stage(bad.join(known, ["reason", "row"], "left_anti"), "rejects").write.mode("append").parquet(path)


def load_metadata(
    to: Corpus, export: DataFrame, landing: str, rendition: str | None = VIEWABLE_RENDITION, rejects: str | None = None
) -> None:
    """Insert document versions not known yet; known versions stay untouched.

    Rows that cannot be loaded go to the Parquet table at ``rejects``, when it is given, and never into the metadata.
    """
    rows, bad = split_export(export, landing)
    if rejects is not None:
        keep_rejects(bad, rejects)
    if rendition is not None:
        rows = rows.filter(F.col("rendition_type") == rendition)
    insert_versions(to, rows)


def insert_versions(to: Corpus, rows: DataFrame) -> None:
    """Add the rows whose version key is not known yet, once each, under new ids."""
    known = to.read("docs_metadata")
    new = rows.join(known.select(*VERSION_KEY), VERSION_KEY, "left_anti")
    keyed = surrogate_keys(new, known, "metadata_id", [F.col("document_id"), *[F.col(c) for c in VERSION_KEY]])
    keyed = stage(keyed, "new-versions")
    values = {c: F.col(c) for c in keyed.columns}
    values |= {"audit__created_date": to.now, "audit__updated_date": to.now}
    insert = Insert(values, defaults=DEFAULTS["docs_metadata"])
    to.update("docs_metadata", keyed, lambda known: merge(known, keyed, VERSION_KEY, not_matched=insert))


def download(
    to: Corpus, fetcher: Fetcher, partitions: int | None = None, manifest: str | None = None, task_bytes: int | None = None
) -> None:
    """Land the pending documents, record each outcome, and mark the latest version of every number.

    With ``manifest``, a path, objects that an earlier run landed are not fetched again. With ``task_bytes``, a task
    gets documents of about so many bytes, by their ``size``, instead of one of ``partitions`` equal shares.
    """
    known = to.read("docs_metadata")
    pending = known.filter(stages.gate(stages.BY_NAME["download"]))

    def spread(rows: DataFrame) -> DataFrame:
        if task_bytes is not None:
            return spread_by_weight(rows, [F.col("metadata_id")], F.col("size"), task_bytes)
        return rows.repartition(partitions) if partitions else rows

    if manifest is None:
        landed = stage(land_files(spread(pending), fetcher), "landed")
    else:
        landed = land_missing(pending, fetcher, manifest, spread=spread)
    to.write(landed.select(*DOWNLOAD_STATUS.names), "download_status")
    was = known.select("metadata_id", versions.NUMBER, versions.MAJOR, versions.MINOR, F.col("is_latest_doc_in_dl").alias("_was"))
    flags = versions.with_latest(was, "_latest").filter(~F.col("_latest").eqNullSafe(F.col("_was"))).select("metadata_id", "_latest")
    outcome = stage(landed.select("metadata_id", "status").join(flags, "metadata_id", "full_outer"), "download-outcome")
    values = {"download_status": F.coalesce("src.status", "tgt.download_status"), "is_latest_doc_in_dl": F.coalesce("src._latest", "tgt.is_latest_doc_in_dl"),
              "audit__updated_date": to.now}
    to.update("docs_metadata", outcome, lambda known: merge(known, outcome, ["metadata_id"], [Update(values)]))


def extract(to: Corpus, read_pages: Callable[[DataFrame], DataFrame]) -> None:
    """``read_pages`` turns (metadata_id, document_s3_path) into those plus pdf_text and extraction_status."""
    batch = to.batch("extraction", "document_s3_path")
    pages = stage(read_pages(batch), "pages")
    update = {c: F.col(f"src.{c}") for c in ("pdf_text", "extraction_status")}
    insert = {c: F.col(c) for c in ("metadata_id", "document_s3_path", "pdf_text", "extraction_status")}
    dates = {"audit__created_date": to.now, "audit__updated_date": to.now}
    to.update("docs_pages", pages, lambda known: merge(
        known, pages, ["metadata_id"], [Update({**update, "audit__updated_date": to.now})], Insert({**insert, **dates})))
    to.write_status(pages.select("metadata_id", "extraction_status"), "extraction_status")


def chunk(to: Corpus) -> None:
    """Replace the chunks of every document of the batch; documents without pages end as FAILED."""
    batch = to.batch("chunking")
    documents = stages.in_batch(to.read("docs_pages"), batch)
    rows = corpus.chunk_pages(documents).withColumns({
        "chunk_id": chunk_key(F.col("metadata_id"), F.col("document_page_number")),
        "audit__created_date": to.now,
        "audit__updated_date": to.now,
    })
    rows = stage(rows, "chunks")
    to.update("docs_embeddings", rows, lambda known: replace_by_key(known, rows, "metadata_id"))
    to.write_status(corpus.chunk_outcome(documents), "chunking_status")


def embed(to: Corpus, run: Callable[[DataFrame], DataFrame]) -> None:
    """``run`` turns chunks into (chunk_id, metadata_id, embedding, embedding_status)."""
    batch = to.batch("embedding")
    chunks = stages.in_batch(to.read("docs_embeddings"), batch)
    done = stage(run(chunks.select("chunk_id", "metadata_id", "chunk_text")), "embeddings")
    values = {c: F.col(f"src.{c}") for c in ("embedding", "embedding_status")}
    to.update("docs_embeddings", done, lambda known: merge(
        known, done, ["chunk_id"], [Update({**values, "audit__updated_date": to.now})]))
    to.write_status(stages.status_rollup(done), "embedding_status", "final_status")


def index(to: Corpus, drop_stale: bool = True) -> None:
    """Bring the search table up to date for the batch; optionally drop vanished and superseded chunks."""
    batch = to.batch("index", "embedding_status")
    chunks, metadata = to.read("docs_embeddings"), to.read("docs_metadata")
    rows = stage(sync.denormalise(stages.in_batch(chunks, batch), metadata), "search-rows")
    touched, gone = rows.select("chunk_id"), None
    if drop_stale:
        present = to.read("docs_embeddings_sync").select("chunk_id").union(touched)
        gone = sync.gone_chunks(present, chunks, versions.superseded(metadata))
        touched = touched.union(gone)

    def refresh(table: DataFrame) -> DataFrame:
        table = sync.upsert_search_rows(table, rows, to.as_of)
        return table if gone is None else table.join(gone, "chunk_id", "left_anti")

    to.update("docs_embeddings_sync", touched, refresh)
    to.write_status(stages.carry_status(batch), "index_status")
