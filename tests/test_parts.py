from pathlib import Path

from conftest import rows
from docloom.sources import generations
from docloom.staging import scratch_path
from pyspark.sql import functions as F
from pyspark.sql import types as T


def test_many_parts_have_few_folders_and_stay_apart(spark):
    path = scratch_path(spark, "parts")
    table = generations.VersionedTable(spark, path, T.StructType.fromDDL("metadata_id long, v string"), generations.ranged("metadata_id", 2))
    table.create()
    first = table.publish(spark.range(4000).select(F.col("id").alias("metadata_id"), F.lit("a").alias("v")))
    assert len(table.folders(first)) == 2000
    folders = list(Path(path.removeprefix("file:")).glob("rows/*/*=*"))
    assert 0 < len(folders) <= generations.BANDS
    parts = [3, 3 + generations.BANDS]
    second = table.publish(table.read(parts=parts).withColumn("v", F.lit("b")), parts)
    assert sorted(r.part for r in table.differing(first, second).collect()) == parts
    assert rows(table.read().filter("v = 'b'"), "metadata_id") == [(6,), (7,), (518,), (519,)]
    assert table.read().count() == 4000 and table.read(first).filter("v = 'b'").count() == 0
    assert rows(table.read(parts=[3]), "metadata_id") == [(6,), (7,)]
    assert table.changes(first, second, "metadata_id", ["v"]).count() == 4
