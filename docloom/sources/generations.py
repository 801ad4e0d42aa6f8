"""Tables that keep their published versions, and publish only the parts a batch touches.

Rows are dealt to parts by an expression over their columns, such as a range or a hash of their id. A version is a
list that names the folder of every part that has rows; publishing writes folders with the touched parts and a new list, and all other parts keep the folder they
have. Parts share a folder from ``BANDS`` parts on, so a publish has a bounded number of folders however many parts there are. The list is one small file, written last: a version is either there with all its parts or not at all, and what
is being read is never overwritten. Changes between two versions are looked for only in parts whose folder differs.

One writer at a time publishes to a table; any number may read. A reader that needs a version for longer takes a hold
on it, and retention leaves held versions alone.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docloom.operators.merge import change_set

_VERSIONS = "number long, time timestamp, part int, folder string"
_HOLDS = "holder string, number long, until timestamp"
PART, BAND, PUBLISH = "_part", "_band", "publish"
BANDS = 256  # folders of a publish at most
NO_PART = -1  # the row that says a version exists, also when it is empty


def _delete(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def ranged(key: str, width: int) -> str:
    """Part of a whole number: ``width`` neighbours share one. Ids that rise with time keep new rows in few parts."""
    return f"CAST({key} DIV {width} AS INT)"


def hashed(key: str, parts: int) -> str:
    """Part of any key, by hash: a fixed number of parts of about equal size."""
    return f"CAST(pmod(xxhash64(CAST({key} AS STRING)), {parts}) AS INT)"


@dataclass(frozen=True)
class VersionedTable:
    """A table at ``path``. ``part`` is SQL text over its columns (see ``ranged`` and ``hashed``), 0 or more.

    ``part`` is fixed once the table has rows. A version's list has one row per part with rows: choose parts of
    a gigabyte or so, then it stays small enough for the driver at any table size. NULL counts as part 0.
    """

    spark: SparkSession
    path: str
    schema: T.StructType
    part: str = hashed("metadata_id", 256)

    def part_of(self) -> Column:
        return F.coalesce(F.expr(self.part), F.lit(0))

    def create(self) -> None:
        """Version 0, without rows; nothing happens when the table is there."""
        if not self.versions():
            self._commit(0, {})

    def versions(self) -> list[tuple[int, datetime]]:
        """(number, time) of every version that can be read, oldest first."""
        rows = self._list().filter(F.col("part") == NO_PART).select("number", "time").distinct().collect()
        return sorted((r.number, r.time) for r in rows)

    def latest(self) -> int:
        found = self.versions()
        if not found:
            raise ValueError(f"no version of {self.path}")
        return found[-1][0]

    def folders(self, number: int) -> dict[int, str]:
        rows = self._list().filter(F.col("number") == number).collect()
        if not rows:
            raise ValueError(f"version {number} of {self.path} is not there, or not any more")
        return {r.part: r.folder for r in rows if r.part != NO_PART}

    def read(self, number: int | None = None, parts: Iterable[int] | None = None) -> DataFrame:
        """The rows as of a version (the latest, unless it is given), of some parts or of all."""
        return self._rows(self.latest() if number is None else number, parts)

    def touched(self, batch: DataFrame) -> list[int]:
        """The parts that hold the keys of ``batch``, which must have the columns that ``part`` is made of."""
        return sorted(r.part for r in batch.select(self.part_of().alias("part")).distinct().collect())

    def publish(self, rows: DataFrame, parts: Sequence[int] | None = None) -> int:
        """A new version in which ``rows`` are all the rows of ``parts`` (of every part, unless given); returns its number.

        Rows of any other part are an error, found before the version is there.
        """
        before = self.latest()
        kept = {} if parts is None else {p: f for p, f in self.folders(before).items() if p not in set(parts)}
        folder = f"{self.path}/rows/{PUBLISH}=p{uuid.uuid4().hex}"
        dealt = rows.select(*[F.col(f.name).cast(f.dataType) for f in self.schema]).withColumn(PART, self.part_of())
        dealt = dealt.withColumn(BAND, F.pmod(F.col(PART), F.lit(BANDS)))
        # Rows of a band together, so that it has few files; Spark splits a band that is too large for one task.
        dealt.hint("rebalance", F.col(BAND)).sortWithinPartitions(BAND, PART).write.partitionBy(BAND).parquet(folder)
        written = [r[PART] for r in self.spark.read.schema(self._stored()).parquet(folder).select(PART).distinct().collect()]
        stray = set() if parts is None else set(written) - set(parts)
        if stray:
            raise ValueError(f"rows outside the parts to be published: {sorted(stray)[:10]}")
        self._commit(before + 1, kept | {p: f"{folder}/{BAND}={p % BANDS}" for p in written})
        return before + 1

    def changes(self, after: int, until: int, key: str, columns: Sequence[str]) -> DataFrame:
        """The change feed: (version, key, change_type, columns) of every version above ``after`` up to ``until``.

        Compares neighbouring versions, and of those only the parts whose folder differs. ``key`` names the
        column that is unique within a version; rows in which it is NULL take no part.
        """
        numbers = [n for n, _ in self.versions() if after <= n <= until]
        if not numbers or numbers[0] != after or numbers[-1] != until:
            raise ValueError(f"versions {after} and {until} of {self.path} are not both there")
        lists = {n: self.folders(n) for n in numbers}
        feeds = []
        for old, new in zip(numbers, numbers[1:]):
            differing = sorted(p for p in lists[old].keys() | lists[new].keys() if lists[old].get(p) != lists[new].get(p))
            sides = [self._rows(n, differing) for n in (old, new)]
            feeds.append(change_set(*sides, key, columns).select(F.lit(new).cast("long").alias("version"), "*"))
        nothing = change_set(self._none(), self._none(), key, columns).select(F.lit(0).cast("long").alias("version"), "*")
        return reduce(DataFrame.unionByName, feeds, nothing)

    def hold(self, holder: str, number: int, until: datetime) -> None:
        """Keep a version for ``holder`` until a time or ``release``. An error when it has gone already."""
        self._append([(holder, number, until)], _HOLDS, "holds")
        self.folders(number)

    def release(self, holder: str) -> None:
        """End all holds of ``holder``, which is a row of its own: the latest row of a holder and version counts."""
        held = self._table(_HOLDS, "holds").filter(F.col("holder") == holder).select("number").distinct().collect()
        if held:
            self._append([(holder, r.number, datetime(1970, 1, 1)) for r in held], _HOLDS, "holds")

    def sweep(self, keep: int, now: datetime) -> list[int]:
        """Remove all but the newest ``keep`` versions and those held beyond ``now``; returns the numbers removed.

        The lists go first, so that no new reader can begin; a hold taken meanwhile brings its version back. A
        folder is deleted only when no version left names it.
        """
        numbers = [n for n, _ in self.versions()]
        old = [n for n in numbers[:-keep or None] if n not in self._held(now)]
        rows = self._list().filter(F.col("number").isin(old)).collect()
        for n in old:
            _delete(self.spark, f"{self.path}/versions/number={n}")
        back = self._held(now) & set(old)
        for n in back:
            self._write_list([r for r in rows if r.number == n], n)
        # Without the list of what is left nothing is deleted.
        named = {r.folder for r in self._list().select("folder").distinct().collect()}
        gone = {r.folder for r in rows if r.folder and r.folder not in named}
        for folder in gone:
            _delete(self.spark, folder)
        return [n for n in old if n not in back]

    def _held(self, now: datetime) -> set[int]:
        holds = self._table(_HOLDS, "holds")
        last = holds.groupBy("holder", "number").agg(F.max(F.struct("taken", "until")).alias("last"))
        return {r.number for r in last.filter(F.col("last.until") > F.lit(now)).select("number").distinct().collect()}

    def differing(self, old: int, new: int) -> DataFrame:
        """(part) of every part whose folder is not the same in two versions, as a table: there may be many."""
        sides = [self._list().filter((F.col("number") == n) & (F.col("part") != NO_PART)).select("part", F.col("folder").alias(name))
                 for n, name in ((old, "_old"), (new, "_new"))]
        return sides[0].join(sides[1], "part", "full_outer").filter(~F.col("_old").eqNullSafe(F.col("_new"))).select("part")

    def _stored(self) -> T.StructType:
        """A row as it lies in a folder; the last columns come from the folder's name."""
        return T.StructType([*self.schema, T.StructField(PART, T.IntegerType()), T.StructField(PUBLISH, T.StringType()), T.StructField(BAND, T.IntegerType())])

    def _none(self) -> DataFrame:
        return self.spark.createDataFrame([], self.schema)

    def _rows(self, number: int, parts: Iterable[int] | None) -> DataFrame:
        """Rows of a version's parts. A folder may hold other parts, too, whose rows have moved on since."""
        named = self.folders(number)
        wanted = named if parts is None else {p: named[p] for p in set(parts) if p in named}
        folders = sorted(set(wanted.values()))
        if not folders:
            return self._none()
        base = f"{self.path}/rows"
        listed = self._list().filter((F.col("number") == number) & (F.col("part") != NO_PART)).select(
            F.col("part").alias(PART), F.regexp_extract("folder", f"/{PUBLISH}=([^/]+)/", 1).alias(PUBLISH))
        if parts is not None:
            listed = listed.join(self.spark.createDataFrame([(p,) for p in wanted], f"{PART} int"), PART, "left_semi")
        found = self.spark.read.schema(self._stored()).option("basePath", base).parquet(*folders)
        return found.join(listed, [PART, PUBLISH], "left_semi").select(*self.schema.names)

    def _table(self, schema: str, name: str) -> DataFrame:
        """A small table of this table's book-keeping; empty before its first row."""
        folder = f"{self.path}/{name}"
        kind = T.StructType.fromDDL(schema)
        path = self.spark._jvm.org.apache.hadoop.fs.Path(folder)
        there = path.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(path)
        rows = self.spark.read.schema(kind).parquet(folder) if there else self.spark.createDataFrame([], kind)
        return rows.withColumn("taken", F.col("_metadata.file_modification_time") if there else F.current_timestamp())

    def _list(self) -> DataFrame:
        return self._table(_VERSIONS, "versions")

    def _append(self, rows: list, schema: str, name: str) -> None:
        self.spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{self.path}/{name}")

    def _commit(self, number: int, folders: dict[int, str]) -> None:
        now = datetime.now()
        self._write_list([(number, now, NO_PART, None), *((number, now, p, f) for p, f in sorted(folders.items()))], number)

    def _write_list(self, rows: list, number: int) -> None:
        """One file per version. A second writer of the same number fails instead of taking the version over."""
        listed = [tuple(r)[1:4] for r in rows]
        self.spark.createDataFrame(listed, "time timestamp, part int, folder string").coalesce(1).write.mode("error").parquet(
            f"{self.path}/versions/number={number}")
