"""Where rows go: tables, the JSON watermark, table definitions, landed files."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator, Mapping

import pandas as pd
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom.functions.metadata import iso_timestamp
from docloom.schemas import BUCKETED, COMPLETED, DEFAULTS, FAILED, ISO_PATTERN, TABLES
from docloom.staging import stage

ACCEPTED_CONTENT = "application/octet-stream"

Fetcher = Callable[[pd.DataFrame], Iterator[tuple[str, bytes]]]


def overwrite_table(df: DataFrame, table: str) -> DataFrame:
    df.write.mode("overwrite").saveAsTable(table)
    return df.sparkSession.table(table)


def stage_table(df: DataFrame, table: str, path: str) -> DataFrame:
    """Materialise as an external Parquet table, so that slow work below it runs once."""
    df.write.format("parquet").mode("overwrite").option("path", path).saveAsTable(table)
    return df.sparkSession.table(table)


def next_watermark(
    df: DataFrame, column: str = "version_modified_date", out: str = "incremental_date", pattern: str = ISO_PATTERN
) -> DataFrame:
    """The text of the latest time in ``column``; text that is no time does not count. NULL when there is none."""
    return df.agg(F.max_by(column, iso_timestamp(F.col(column), pattern)).alias(out))


def write_watermark(watermark: DataFrame, path: str) -> None:
    """One row, one file."""
    watermark.coalesce(1).write.mode("overwrite").json(path)


def read_watermark(spark: SparkSession, path: str, out: str = "incremental_date") -> DataFrame:
    return spark.read.schema(f"{out} STRING").json(path)


def create_tables(
    spark: SparkSession, database: str, root: str | None = None, buckets: int | None = None
) -> list[str]:
    """Create the corpus tables that do not exist yet, with their nested types and column defaults.

    A table that exists gets the columns it lacks, and the present defaults on all of them; rows
    already there read NULL in new columns. With ``buckets``, tables joined on ``metadata_id`` are bucketed by it.
    """
    names = []
    for table, schema in TABLES.items():
        defaults: Mapping[str, str] = DEFAULTS[table]
        columns = ", ".join(
            f"`{f.name}` {f.dataType.simpleString()}" + (f" DEFAULT {defaults[f.name]}" if f.name in defaults else "")
            for f in schema
        )
        location = f" LOCATION '{root.rstrip('/')}/{table}'" if root else ""
        bucketed = table in BUCKETED and buckets
        name = f"{database}.{table}"
        if spark.catalog.tableExists(name):
            known = set(spark.table(name).columns)
            added = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema if f.name not in known)
            if added:
                spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({added})")
            for column, value in defaults.items():
                spark.sql(f"ALTER TABLE {name} ALTER COLUMN `{column}` SET DEFAULT {value}")
        clause = f" CLUSTERED BY (metadata_id) SORTED BY (metadata_id) INTO {buckets} BUCKETS" if bucketed else ""
        spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet{clause}{location}")
        names.append(name)
    return names


def _filesystem(uri: str) -> tuple[pafs.FileSystem, str]:
    if uri.startswith("file:/") and not uri.startswith("file://"):
        uri = "file://" + uri.removeprefix("file:")
    return pafs.FileSystem.from_uri(uri)


def _store(uri: str, body: bytes) -> None:
    filesystem, path = _filesystem(uri)
    filesystem.create_dir(path.rsplit("/", 1)[0], recursive=True)
    with filesystem.open_output_stream(path) as out:
        out.write(body)


def _is_there(uri: str, length: int, digest: str | None) -> bool:
    """Whether an object of this length lies at ``uri``, with this SHA-256 when one is given."""
    try:
        filesystem, path = _filesystem(uri)
        info = filesystem.get_file_info(path)
        if not info.is_file or info.size != length:
            return False
        if digest is None:
            return True
        with filesystem.open_input_file(path) as stored:
            return hashlib.file_digest(stored, "sha256").hexdigest() == digest
    except Exception:  # what cannot be looked at is fetched again
        return False


def land_files(
    df: DataFrame,
    fetcher: Fetcher,
    path_column: str = "document_s3_path",
    partitions: int | None = None,
    accepted: str = ACCEPTED_CONTENT,
) -> DataFrame:
    """Fetch and store one object per row in parallel: (metadata_id, status, error).

    ``fetcher`` yields (content type, bytes) for each row of a batch, in order; it is called once per
    batch, and row by row from where a batch breaks off, so one bad row cannot fail its neighbours.
    An unexpected content type or any error gives FAILED for that row and says why in ``error``.
    Writing replaces the whole object, so a retried task ends in the same state. The result is lazy:
    stage it, since every read lands anew.
    """
    spread = df.repartition(partitions) if partitions else df
    return _landing(spread, fetcher, path_column, accepted).select("metadata_id", "status", "error")


def _landing(df: DataFrame, fetcher: Fetcher, path_column: str, accepted: str, verify: bool = False) -> DataFrame:
    """Rows with a ``known_length`` whose object is still there are not fetched."""

    def fetched(frame: pd.DataFrame) -> Iterator[tuple[str | None, int | None, str | None]]:
        """(error, length, digest) of each row."""
        answers, single = None, False
        for i in range(len(frame)):
            try:
                if not single:
                    try:
                        answers = iter(fetcher(frame)) if answers is None else answers
                        kind, body = next(answers)
                    except Exception:
                        single = True
                if single:
                    kind, body = next(iter(fetcher(frame.iloc[i:i + 1])))
                if accepted in kind:
                    _store(frame[path_column].iloc[i], body)
                    yield None, len(body), hashlib.sha256(body).hexdigest()
                else:
                    yield f"content type {kind}", None, None
            except Exception as error:
                yield f"{type(error).__name__}: {error}", None, None

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            missing = pd.Series(True, index=frame.index)
            if "known_length" in frame:
                known = zip(frame[path_column], frame["known_length"], frame["known_digest"], strict=True)
                missing[:] = [pd.isna(n) or not _is_there(p, int(n), d if verify else None) for p, n, d in known]
            out = pd.DataFrame({"metadata_id": frame["metadata_id"], "path": frame[path_column], "fetched": missing, "status": COMPLETED, "error": None})
            out["length"] = frame.get("known_length", pd.Series(pd.NA, index=frame.index)).astype("Int64")
            out["digest"] = frame.get("known_digest", pd.Series(None, index=frame.index, dtype=object))
            todo = frame[missing].drop(columns=["known_length", "known_digest"], errors="ignore")
            results = list(fetched(todo)) if len(todo) else []
            out.loc[missing, "error"] = pd.Series([e for e, _, _ in results], index=todo.index, dtype=object)
            out.loc[missing, "status"] = [COMPLETED if e is None else FAILED for e, _, _ in results]
            out.loc[missing, "length"] = pd.array([n for _, n, _ in results], dtype="Int64")
            out.loc[missing, "digest"] = pd.Series([d for _, _, d in results], index=todo.index, dtype=object)
            yield out

    return df.mapInPandas(run, "metadata_id bigint, path string, fetched boolean, status string, error string, length bigint, digest string")


MANIFEST = "path string, length bigint, digest string, landed_at timestamp"


def land_missing(
    df: DataFrame,
    fetcher: Fetcher,
    manifest: str,
    path_column: str = "document_s3_path",
    spread: Callable[[DataFrame], DataFrame] | None = None,
    accepted: str = ACCEPTED_CONTENT,
    verify: bool = False,
) -> DataFrame:
    """Land what is not there yet: (metadata_id, path, fetched, status, error, length, digest), staged.

    The Parquet table at ``manifest`` has a row for every object landed before. A row is fetched only when its path
    is not in it, or its object is gone or of another length, or with ``verify`` of another SHA-256. The manifest is added
    to after the objects are stored, so a crash in between fetches them once more and loses none. ``spread``
    deals the rows to tasks.
    """
    spark = df.sparkSession
    spark.createDataFrame([], MANIFEST).write.mode("append").parquet(manifest)
    known = spark.read.schema(MANIFEST).parquet(manifest).groupBy(F.col("path").alias("_path")).agg(
        F.max_by("length", "landed_at").alias("known_length"), F.max_by("digest", "landed_at").alias("known_digest"))
    todo = df.join(known, df[path_column] == F.col("_path"), "left").drop("_path")
    landed = stage(_landing(spread(todo) if spread else todo, fetcher, path_column, accepted, verify), "landed")
    new = landed.filter(F.col("fetched") & (F.col("status") == COMPLETED))
    new.select("path", "length", "digest", F.current_timestamp().alias("landed_at")).write.mode("append").parquet(manifest)
    return landed
