"""Column builders that shape an export into the metadata table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def normalise_names(df: DataFrame) -> DataFrame:
    """``.`` becomes ``_`` and one trailing ``__v`` goes, for every column at once."""
    return df.toDF(*[name.replace(".", "_").removesuffix("__v") for name in df.columns])


def composite_path(document_id: Column, number: Column) -> Column:
    return F.concat(document_id, F.lit("/"), number)


def batch_number(key: Column, batches: int) -> Column:
    """Batch of a key in ``[0, batches)``. Hashing makes it independent of partitioning and reruns."""
    return F.pmod(F.xxhash64(key), F.lit(batches))


def id_batch(number: Column, batches: int) -> Column:
    """Batch of a dense whole-number id: as even as hashing, and readable off the id."""
    return F.pmod(number, F.lit(batches))


def extension(path: Column) -> Column:
    """What follows the last dot, or the whole path when it has none."""
    return F.element_at(F.split(path, r"\."), -1)


def landing_prefix(as_of: Column) -> Column:
    return F.concat(F.lit("landing/"), F.date_format(as_of, "yyyy_MM_dd_HH_mm_ss"))


def target_path(prefix: Column, batch_id: Column, number: Column, source_path: Column) -> Column:
    return F.concat(
        prefix, F.lit("/batch_id="), batch_id.cast("string"), F.lit("/"), number, F.lit("."), extension(source_path)
    )


def iso_timestamp(text: Column, pattern: str) -> Column:
    """Text to timestamp in the session zone; the pattern's ``Z`` is a literal. Bad text gives NULL."""
    return F.try_to_timestamp(text, F.lit(pattern))


def document_prefix(number: Column) -> Column:
    return F.substring_index(number, "-", 1)


def align(df: DataFrame, target: T.StructType, reject: str | None = None) -> DataFrame:
    """Project ``df`` on the target's columns, in its order and types.

    Columns the source lacks are left out and extras are dropped. A value that does not cast
    becomes NULL; with ``reject`` a boolean column of that name marks such rows.
    """
    present = [f for f in target if f.name in df.columns]
    cast = [F.col(f"`{f.name}`").try_cast(f.dataType).alias(f.name) for f in present]
    if reject is None:
        return df.select(*cast)
    lost = F.lit(False)
    for f in present:
        source = F.col(f"`{f.name}`")
        lost = lost | (source.isNotNull() & source.try_cast(f.dataType).isNull())
    return df.select(*cast, lost.alias(reject))
