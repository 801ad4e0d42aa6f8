"""The metadata load, full and incremental in one: which documents, since when, and how far it got.

A load asks for its documents in slices of ids, or takes a whole export; keeps what the rules let in and what is not
older than the watermark; adds the versions not known yet; and only then commits the new watermark. A run that breaks
off before that is repeated from the old watermark: versions it had added are known by then and are not added again.
The watermark itself is taken in again, so a row that arrives late with the same time is not lost either.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docloom.functions.metadata import iso_timestamp
from docloom.operators.positions import id_slices
from docloom.operators.rules import matching
from docloom.plans.jobs import Corpus, insert_versions, keep_rejects, split_export
from docloom.schemas import EXPORT_SCHEMA, IDS_PER_REQUEST, ISO_PATTERN, VERSION_KEY, VIEWABLE_RENDITION
from docloom.staging import stage

Exporter = Callable[[list[str]], Iterator[pd.DataFrame]]

MARK = "incremental_date"


def export_slices(numbers: DataFrame, exporter: Exporter, size: int = IDS_PER_REQUEST, schema: T.StructType = EXPORT_SCHEMA) -> DataFrame:
    """The export rows of all document numbers, asked for in requests of ``size`` ids, one task per request, and staged.

    ``exporter`` turns a list of ids into frames with the columns of ``schema``, as text; columns it leaves out are
    NULL. Its errors fail the task, which is tried again: a load never goes on without a slice.
    """
    slices = stage(id_slices(numbers.filter("document_number IS NOT NULL"), "document_number", size), "id-slices")
    requests = slices.repartition(max(1, slices.count()), "slice_no").select("ids")

    def ask(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for ids in frame["ids"]:
                for rows in exporter(list(ids)):
                    yield rows.reindex(columns=schema.names).astype(object).where(lambda x: x.notna(), None)

    return stage(requests.mapInPandas(ask, schema), "exported")


def read_mark(spark: SparkSession, path: str, pattern: str = ISO_PATTERN) -> str | None:
    """The latest watermark that was committed; text that is no time does not count. None before the first."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder):
        return None
    marks = spark.read.schema(f"{MARK} string").json(path)
    return marks.agg(F.max_by(MARK, iso_timestamp(F.col(MARK), pattern)).alias(MARK)).first()[MARK]


def commit_mark(spark: SparkSession, path: str, mark: str) -> None:
    """Add a watermark. Earlier ones stay, so there is no moment without one."""
    spark.createDataFrame([(mark,)], f"{MARK} string").coalesce(1).write.mode("append").json(path)


def since(rows: DataFrame, mark: str | None, overlap_days: int = 0, column: str = "version_modified_date", pattern: str = ISO_PATTERN) -> DataFrame:
    """Rows not older than the watermark (less an overlap for sources that report late), and rows whose time cannot be read."""
    if mark is None:
        return rows
    time = iso_timestamp(F.col(column), pattern)
    start = iso_timestamp(F.lit(mark), pattern) - F.make_interval(days=F.lit(overlap_days))
    return rows.filter(time.isNull() | (time >= start))


def load(
    to: Corpus, export: DataFrame, landing: str, mark: str, rules: DataFrame | None = None, rendition: str | None = VIEWABLE_RENDITION,
    rejects: str | None = None, overlap_days: int = 0, pattern: str = ISO_PATTERN,
) -> str | None:
    """Add the versions of ``export`` that are wanted and not known; returns the committed watermark.

    ``export``: a file export or the result of ``export_slices``. ``mark``: where watermarks are kept; without one yet the
    load is a full one. ``rules``: see ``operators.rules``; all documents are wanted without. The watermark is the
    latest time among all rows of the export, wanted or not, and never goes back.
    """
    spark, last = to.spark, read_mark(to.spark, mark, pattern)
    rows, bad = split_export(export, landing)
    if rejects is not None:
        keep_rejects(bad, rejects)
    time = iso_timestamp(F.col("version_modified_date"), pattern)
    newest = rows.agg(F.max_by("version_modified_date", time).alias("at")).first()["at"]
    wanted = since(rows, last, overlap_days, pattern=pattern)
    if rendition is not None:
        wanted = wanted.filter(F.col("rendition_type") == rendition)
    if rules is not None:
        wanted = matching(wanted, rules)
    # The same version may come in several slices or renditions: one row of each is added, by the least of all its columns.
    others = [c for c in wanted.columns if c not in VERSION_KEY]
    one = wanted.groupBy(*VERSION_KEY).agg(F.min(F.struct(*others)).alias("_row")).select(*VERSION_KEY, *[f"_row.{c}" for c in others])
    insert_versions(to, one.select(*wanted.columns))
    later = newest is not None and (last is None or spark.range(1).select(
        (iso_timestamp(F.lit(newest), pattern) > iso_timestamp(F.lit(last), pattern)).alias("later")).first().later)
    if later:
        commit_mark(spark, mark, newest)
    return newest if later else last
