"""Key-based merges over plain frames, replace-by-key, change sets, and publishing the result.

A merge never shuffles the target when the change batch is small: matched rows come from a left
outer join (Spark may broadcast the batch, and may split hot target keys), new rows from an anti
join against only those target keys that the batch touches. A full outer join allows neither.
Key sets are staged, so that the join with them is planned by their real size.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docloom.staging import scratch_root, stage


@dataclass(frozen=True)
class Update:
    """Set target columns on a match; values may use ``tgt.`` and ``src.`` columns."""

    values: Mapping[str, Column]
    when: Column | None = None


@dataclass(frozen=True)
class Delete:
    """Drop the target row on a match."""

    when: Column | None = None


@dataclass(frozen=True)
class Insert:
    """Add an unmatched source row. Columns it omits take their default, or else NULL.

    ``values`` maps target columns to expressions over source columns; None takes every
    target column the source has.
    """

    values: Mapping[str, Column] | None = None
    when: Column | None = None
    defaults: Mapping[str, str] = field(default_factory=dict)


def merge(
    target: DataFrame,
    source: DataFrame,
    on: Sequence[str],
    matched: Sequence[Update | Delete] = (),
    not_matched: Insert | None = None,
) -> DataFrame:
    """The target after applying ``source``.

    The first matched clause whose condition holds applies. NULL keys never match. Two source
    rows for one updated target row are an error at run time, even when a clause condition
    would choose between them; unmatched duplicates are all inserted. The source is read several
    times (one small job looks for repeated keys), so stage it when it is costly.
    """
    on = list(on)
    kept = _apply_matched(target, source, on, matched) if matched else target
    if not_matched is None:
        return kept
    return kept.unionByName(_new_rows(target, source, on, not_matched))


def _same_key(on: Sequence[str], right: str) -> Column:
    return reduce(and_, [F.col(f"tgt.{k}") == F.col(f"{right}.{k}") for k in on])


def _nullable(kind: T.DataType) -> T.DataType:
    """The type with NULL allowed at every level: a target built in the same query may forbid it inside."""
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(_nullable(kind.elementType))
    if isinstance(kind, T.MapType):
        return T.MapType(_nullable(kind.keyType), _nullable(kind.valueType))
    if isinstance(kind, T.StructType):
        return T.StructType([T.StructField(f.name, _nullable(f.dataType)) for f in kind])
    return kind


def _apply_matched(
    target: DataFrame, source: DataFrame, on: list[str], clauses: Sequence[Update | Delete]
) -> DataFrame:
    if len(clauses) == 1 and isinstance(clauses[0], Delete) and clauses[0].when is None:
        keys = stage(source.select(*on).distinct(), "keys")
        return target.join(keys, on, "left_anti").select(*target.columns)

    checked = target.alias("tgt").join(
        source.withColumn("_hit", F.lit(True)).alias("src"), _same_key(on, "src"), "left"
    )
    repeated = source.groupBy(*on).agg(F.count(F.lit(1)).alias("_rows")).filter("_rows > 1")
    if not repeated.isEmpty():
        # Only then is a second join needed; without it Spark can split hot target keys in the first.
        # A filter, not a column: projections above cannot prune the check away.
        several = F.lit(f"several source rows match one target row on {', '.join(on)}")
        checked = checked.join(repeated.alias("dup"), _same_key(on, "dup"), "left").filter(
            F.when(F.col("dup._rows").isNotNull(), F.raise_error(several).cast("boolean")).otherwise(F.lit(True))
        )

    hit = F.coalesce(F.col("src._hit"), F.lit(False))
    fires = [hit if c.when is None else hit & F.coalesce(c.when, F.lit(False)) for c in clauses]
    for i, clause in enumerate(clauses):
        if isinstance(clause, Delete):
            earlier = reduce(lambda a, b: a | b, fires[:i], F.lit(False))
            checked = checked.filter(earlier | ~fires[i])

    columns = []
    for f in target.schema:
        current = F.col(f"tgt.{f.name}")
        branches = [
            (cond, clause.values.get(f.name, current).cast(_nullable(f.dataType)))
            for cond, clause in zip(fires, clauses)
            if isinstance(clause, Update)
        ]
        if any(f.name in c.values for c in clauses if isinstance(c, Update)):
            value = reduce(lambda acc, b: acc.when(*b), branches[1:], F.when(*branches[0])).otherwise(current)
        else:
            value = current
        columns.append(value.alias(f.name))
    return checked.select(*columns)


def _new_rows(target: DataFrame, source: DataFrame, on: list[str], clause: Insert) -> DataFrame:
    touched = stage(target.select(*on).join(source.select(*on), on, "left_semi").distinct(), "touched")
    new = source.join(touched, on, "left_anti")
    if clause.when is not None:
        new = new.filter(clause.when)
    values = clause.values
    if values is None:
        values = {name: F.col(name) for name in target.columns if name in source.columns}
    columns = []
    for f in target.schema:
        if f.name in values:
            value = values[f.name]
        elif f.name in clause.defaults:
            value = F.expr(clause.defaults[f.name])
        else:
            value = F.lit(None)
        columns.append(value.cast(_nullable(f.dataType)).alias(f.name))
    return new.select(*columns)


def update_column(
    target: DataFrame,
    source: DataFrame,
    on: str,
    column: str,
    value: str | None = None,
    as_of: Column | None = None,
    audit: str = "audit__updated_date",
) -> DataFrame:
    """Write a source column (same name unless ``value`` is given) back to the target, with the audit time."""
    values = {column: F.col(f"src.{value or column}")}
    if audit in target.columns:
        values[audit] = F.current_timestamp() if as_of is None else as_of
    return merge(target, source, [on], [Update(values)])


def replace_by_key(
    target: DataFrame, source: DataFrame, key: str, defaults: Mapping[str, str] | None = None
) -> DataFrame:
    """All target rows of every key in ``source`` give way to that key's source rows, in one result."""
    keys = stage(source.select(key).distinct(), "keys")
    kept = target.join(keys, key, "left_anti").select(*target.columns)
    given = set(source.columns)
    columns = []
    for f in target.schema:
        if f.name in given:
            value = F.col(f.name)
        else:
            value = F.expr((defaults or {}).get(f.name, "NULL"))
        columns.append(value.cast(_nullable(f.dataType)).alias(f.name))
    return kept.unionByName(source.select(*columns))


def change_set(before: DataFrame, after: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """What turned ``before`` into ``after``: one row per inserted, updated or deleted key.

    Keys must be unique on both sides; all ``columns`` are compared, NULL equal to NULL. Only keys and
    row digests are shuffled to find the changes, which are staged; full rows are then looked up by key.
    """
    def digest(df: DataFrame, name: str) -> DataFrame:
        row = F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})
        return df.select(key, F.sha2(row, 256).alias(name))

    old, new = digest(before, "_old"), digest(after, "_new")
    kind = F.when(F.col("_old").isNull(), "insert").when(F.col("_new").isNull(), "delete").otherwise("update")
    changed = stage(
        old.join(new, key, "full_outer")
        .filter(~F.col("_old").eqNullSafe(F.col("_new")))
        .select(key, kind.alias("change_type")),
        "changes",
    )
    arrived = after.select(key, *columns).join(changed.filter("change_type <> 'delete'"), key)
    removed = before.select(key, *columns).join(changed.filter("change_type = 'delete'"), key)
    return arrived.unionByName(removed).select(key, "change_type", *columns)


def publish(df: DataFrame, table: str, root: str | None = None, bucket: tuple[int, str] | None = None) -> None:
    """Write ``df`` as a new Parquet directory and point ``table`` at it.

    The directory being read is never overwritten, so ``df`` may derive from the table itself,
    and a failed write leaves the table as it was. ``bucket`` (count, column) must be how the table
    was created: joins of two such tables on that column then need no shuffle.
    """
    spark = df.sparkSession
    name = f"{table.split('.')[-1].strip('`')}-{uuid.uuid4().hex}"
    path = f"{(root or scratch_root(spark)).rstrip('/')}/{name}"
    if bucket is None:
        df.write.parquet(path)
    else:
        # Bucketed files can only be written through a table; dropping it leaves the files.
        count, column = bucket
        writing = f"{table}_{uuid.uuid4().hex[:12]}"
        (df.repartition(count, column).write.format("parquet").bucketBy(count, column).sortBy(column)
           .option("path", path).saveAsTable(writing))
        spark.sql(f"DROP TABLE {writing}")
    spark.sql(f"ALTER TABLE {table} SET LOCATION '{path}'")
    spark.catalog.refreshTable(table)
