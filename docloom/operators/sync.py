"""The search table: denormalised chunks, kept current incrementally."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docloom.functions.metadata import iso_timestamp
from docloom.operators.merge import Insert, Update, merge
from docloom.schemas import COMPLETED, DEFAULTS, ISO_PATTERN, SYNC
from docloom.staging import stage


def denormalise(
    chunks: DataFrame, metadata: DataFrame, columns: Sequence[str] | None = None, pattern: str = ISO_PATTERN
) -> DataFrame:
    """Embedded chunks with their document's columns, shaped like the search table minus its created date.

    Chunks without a vector stay out. The chunk's own columns win where both sides have one.
    """
    wanted = list(columns or [n for n in SYNC.names if n != "audit__created_date"])
    done = chunks.filter(F.col("embedding_status") == COMPLETED)
    own = set(chunks.columns)
    theirs = metadata.select("metadata_id", *[c for c in metadata.columns if c not in own])
    joined = done.join(theirs, "metadata_id", "left").withColumnsRenamed({"status": "document_status"})
    dates = {
        c: iso_timestamp(F.col(c), pattern)
        for c in ("file_modified_date", "version_modified_date")
        if c in joined.columns
    }
    return joined.withColumns(dates).select(*[c for c in wanted if c in joined.columns])


def upsert_search_rows(
    target: DataFrame,
    source: DataFrame,
    as_of: Column | None = None,
    refreshed: Sequence[str] = ("embedding", "chunk_text"),
) -> DataFrame:
    """Refresh vector and text of chunks whose source is strictly newer; add chunks not yet there."""
    stamp = F.current_timestamp() if as_of is None else as_of
    values = {c: F.col(f"src.{c}") for c in refreshed if c in target.columns}
    newer = F.col("tgt.audit__updated_date") < F.col("src.audit__updated_date")
    inserted = {
        c: F.col(c) for c in target.columns
        if c in source.columns and c not in ("audit__created_date", "audit__updated_date")
    }
    audit = {c: stamp for c in ("audit__created_date", "audit__updated_date") if c in target.columns}
    return merge(
        target,
        source,
        ["chunk_id"],
        [Update({**values, "audit__updated_date": stamp}, when=newer)],
        Insert({**inserted, **audit}, defaults=DEFAULTS["docs_embeddings_sync"]),
    )


def gone_chunks(sync: DataFrame, chunks: DataFrame, superseded: DataFrame | None = None) -> DataFrame:
    """Ids (staged) of search rows whose chunk is gone or belongs to a superseded document version."""
    live = chunks.select("chunk_id", "metadata_id")
    if superseded is not None:
        live = live.join(superseded.select("metadata_id"), "metadata_id", "left_anti")
    return stage(sync.select("chunk_id").join(live.select("chunk_id"), "chunk_id", "left_anti"), "gone")


def prune(sync: DataFrame, chunks: DataFrame, superseded: DataFrame | None = None) -> DataFrame:
    """Drop search rows whose chunk is gone or belongs to a superseded document version.

    Ids alone decide; the ids to drop are staged, so Spark knows how few they are and can leave the
    wide rows where they lie.
    """
    return sync.join(gone_chunks(sync, chunks, superseded), "chunk_id", "left_anti")


def latest_per_chunk(changes: DataFrame, version: str = "audit__updated_date", gone: str = "gone") -> DataFrame:
    """The newest state of every chunk in a change log; equal times resolve to the greatest row.

    A log with a ``gone`` column holds tombstones: a chunk whose newest row is one is not there any more.
    At equal times the tombstone wins.
    """
    marked = gone in changes.columns
    others = [c for c in changes.columns if c not in ("chunk_id", version, gone)]
    newest = F.max(F.struct(version, *([gone] if marked else []), *others)).alias("_newest")
    latest = changes.groupBy("chunk_id").agg(newest)
    if marked:
        latest = latest.filter(~F.coalesce(F.col(f"_newest.{gone}"), F.lit(False)))
    return latest.select("chunk_id", *[f"_newest.{c}" for c in (version, *others)])


def compact_log(log: DataFrame, path: str, version: str = "audit__updated_date", gone: str = "gone") -> DataFrame:
    """Write the present state of ``log`` as a new log under ``path``: one row per chunk, no tombstones.

    The result is a table for readers, not a folder a stream can go on writing to; ``streaming.sync_log`` has logs
    that are synced and compacted in turn.
    """
    latest = latest_per_chunk(log, version, gone).withColumn(gone, F.lit(False)).select(*log.columns)
    latest.write.parquet(path)
    return log.sparkSession.read.schema(log.schema).parquet(path)
