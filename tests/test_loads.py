import pandas as pd
import pytest
from conftest import rows
from docloom.functions.filters import FlatFilter, TypeRule, UnitFilter
from docloom.operators import rules
from docloom.plans import jobs, loads
from docloom.schemas import EXPORT_FIELDS
from docloom.sources.generations import VersionedTable, hashed, ranged
from docloom.staging import scratch_path
from pyspark.sql import functions as F
from pyspark.sql import types as T

UNITS = UnitFilter({"en": (TypeRule("a", ("x", "y")), TypeRule("b")), "fr": (TypeRule("a"),)}, ("Approved", "Effective"))
FLAT = FlatFilter(units=("en",), types=(TypeRule("a"), TypeRule("b", ("x",))))


def documents(spark):
    values = [(u, t, s, st) for u in ("en", "fr", None) for t in ("a", "b", None) for s in ("x", "z", None) for st in ("Approved", "Draft", None)]
    return spark.createDataFrame([(i, *v) for i, v in enumerate(values)], "id int, " + ", ".join(f"{c} string" for c in rules.RULE_COLUMNS))


@pytest.mark.parametrize("spec", [UNITS, FLAT, FlatFilter(), FlatFilter(statuses=())])
def test_rule_table_equals_the_predicate(spark, spec):
    table = documents(spark)
    by_rules = rules.matching(table, rules.rules_of(spark, spec).unionByName(rules.rules_of(spark, spec)))
    assert rows(by_rules, "id") == rows(table.filter(F.coalesce(spec.predicate(), F.lit(False))), "id")
    assert by_rules.columns == table.columns


def export_rows(spark, data):
    """(id, number, major, minor, unit, time)"""
    frame = pd.DataFrame([{
        "file": f"/stage/{i}.pdf", "rendition_type": "viewable_rendition__v", "id": str(i), "document_number__v": number, "major_version_number__v": str(major),
        "minor_version_number__v": str(minor), "doc_control_unit__c.name__v": unit, "type__v": "a", "subtype__v": "x", "status__v": "Approved",
        "version_modified_date__v": time} for i, number, major, minor, unit, time in data], columns=EXPORT_FIELDS, dtype=object)
    return spark.createDataFrame(frame.where(frame.notna(), None), T.StructType([T.StructField(c, T.StringType()) for c in EXPORT_FIELDS]))


def at(day):
    return f"2024-01-{day:02d}T00:00:00.000Z"


FIRST = [(1, "A", 1, 0, "en", at(1)), (2, "B", 1, 0, "en", at(5)), (2, "B", 1, 0, "en", at(5)), (3, "C", 1, 0, "xx", at(9)), (4, "D", 1, 0, "en", "unknown")]
SECOND = [(2, "B", 1, 0, "en", at(5)), (5, "E", 1, 0, "en", at(9)), (6, "F", 1, 0, "en", at(8)), (7, "A", 2, 0, "fr", at(12)), (8, "G", 1, 0, "en", "unknown")]


@pytest.fixture()
def to(spark):
    corpus = jobs.Corpus(spark, "loads", root=scratch_path(spark, "loads"), part_width=4)
    corpus.create()
    return corpus


def numbers(to):
    return rows(to.read("docs_metadata"), "document_number", "document_major_version")


def test_incremental_loads_lose_and_double_nothing(to, spark, monkeypatch):
    mark, wanted = f"{to.root}/mark", rules.rules_of(spark, UNITS)
    assert loads.read_mark(spark, mark) is None
    assert loads.load(to, export_rows(spark, FIRST), "landing", mark, wanted) == at(9)
    assert numbers(to) == [("A", 1), ("B", 1), ("D", 1)]
    # The second load breaks off after its versions are there and before the watermark is.
    second = export_rows(spark, SECOND)
    with monkeypatch.context() as broken:
        broken.setattr(loads, "commit_mark", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            loads.load(to, second, "landing", mark, wanted)
    assert loads.read_mark(spark, mark) == at(9)
    for _ in range(2):
        # E has the time of the watermark and stays in; F is older than it.
        assert loads.load(to, second, "landing", mark, wanted) == at(12)
        assert numbers(to) == [("A", 1), ("A", 2), ("B", 1), ("D", 1), ("E", 1), ("G", 1)]
    assert to.read("docs_metadata").select("metadata_id").distinct().count() == 6
    # An older export does not move the watermark back, and an overlap takes in what was late.
    assert loads.load(to, second.filter("id = '6'"), "landing", mark, wanted, overlap_days=5) == at(12)
    assert ("F", 1) in numbers(to)


def test_exports_are_asked_for_in_slices(spark, tmp_path):
    asked = str(tmp_path)

    def exporter(ids):
        import os
        import uuid
        with open(os.path.join(asked, uuid.uuid4().hex), "w") as out:
            out.write(",".join(ids))
        yield pd.DataFrame({"id": ids, "document_number__v": ids})
        yield pd.DataFrame({"id": [], "document_number__v": []})

    ids = spark.createDataFrame([(f"N{i:03d}",) for i in range(25)] * 2 + [(None,)], "document_number string")
    out = loads.export_slices(ids, exporter, size=10)
    assert out.columns == EXPORT_FIELDS and rows(out, "id") == [(f"N{i:03d}",) for i in range(25)]
    assert sorted(len(p.read_text().split(",")) for p in tmp_path.iterdir()) == [5, 10, 10]
    assert loads.export_slices(ids.limit(0), exporter).count() == 0


def test_versions_parts_and_holds(spark):
    from datetime import datetime, timedelta

    table = VersionedTable(spark, scratch_path(spark, "versions"), T.StructType.fromDDL("metadata_id long, v string"), ranged("metadata_id", 10))
    table.create()
    table.create()
    assert table.latest() == 0 and table.read().count() == 0
    assert table.publish(spark.range(40).select(F.col("id").alias("metadata_id"), F.lit("a").alias("v"))) == 1
    batch = spark.createDataFrame([(5, "b"), (44, "n"), (None, "z")], "metadata_id long, v string")
    parts = table.touched(batch)
    assert parts == [0, 4]
    one = table.read(parts=parts).filter("metadata_id <> 5 AND metadata_id <> 6").unionByName(batch)
    assert table.publish(one, parts) == 2 and table.read().count() == 41
    assert [p for p in range(5) if table.folders(2).get(p) != table.folders(1).get(p)] == parts
    feed = table.changes(0, 2, "metadata_id", ["v"]).filter("version = 2")
    assert rows(feed, "metadata_id", "change_type", "v") == [(5, "update", "b"), (6, "delete", "a"), (44, "insert", "n")]
    with pytest.raises(ValueError, match="outside"):
        table.publish(batch, [4])
    assert table.publish(table.read(2, parts=[0]).limit(0), [0]) == 3 and table.read().count() == 31
    now = datetime.now()
    table.hold("reader", 1, now + timedelta(days=1))
    table.hold("other", 2, now - timedelta(days=1))
    held = table.read(1)
    assert table.sweep(1, now) == [0, 2] and [n for n, _ in table.versions()] == [1, 3]
    assert held.count() == 40 and table.read().count() == 31
    with pytest.raises(ValueError):
        table.hold("late", 2, now + timedelta(days=1))
    table.release("reader")
    assert table.sweep(1, now) == [1] and table.read().count() == 31
    assert hashed("metadata_id", 8) != table.part
