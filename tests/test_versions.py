from collections import defaultdict

from conftest import rows
from docloom.operators import positions, versions
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

SCHEMA = "metadata_id bigint, document_number string, document_major_version bigint, document_minor_version bigint"
EDGE = [
    (1, "A-1", 1, 0), (2, "A-1", 1, 1), (3, "A-1", 1, 1), (4, "A-1", None, 9), (5, "A-1", 0, None), (6, "A-1", 0, 3),
    (7, "B", 2, 2), (8, None, 1, 1), (9, None, 2, 1),
]


def expected(data):
    low = float("-inf")
    groups = defaultdict(list)
    for i, number, major, minor in data:
        groups[number].append((low if major is None else major, low if minor is None else minor, i))
    return sorted((i, 1 + sum((a, b) > (x, y) for a, b, _ in g)) for g in groups.values() for x, y, i in g)


def test_ties_and_missing_versions(spark):
    df = spark.createDataFrame(EDGE, SCHEMA)
    want = expected(EDGE)
    assert rows(versions.version_rank(df), "metadata_id", "version_rank") == want
    assert rows(versions.superseded(df)) == [(i,) for i, r in want if r > 1]


def test_every_number_keeps_a_latest_version(spark):
    df = versions.with_latest(spark.createDataFrame(EDGE, SCHEMA))
    assert df.filter("is_latest_doc_in_dl").select("document_number").distinct().count() == 3
    assert df.count() == len(EDGE)


def test_flag_is_set_both_ways(spark):
    df = spark.createDataFrame(EDGE, SCHEMA).withColumn("is_latest_doc_in_dl", F.lit(False))
    assert rows(versions.with_latest(df).filter("is_latest_doc_in_dl"), "metadata_id") == [(2,), (3,), (7,), (9,)]


def test_rank_of_a_number_spread_over_many_partitions(spark):
    data = [(i, "HOT" if i % 3 else f"D{i}", i // 7, i % 5) for i in range(600)]
    df = spark.createDataFrame(data, SCHEMA)
    assert rows(versions.version_rank(df), "metadata_id", "version_rank") == expected(data)


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.integers(0, 10_000), unique=True, max_size=60), st.integers(1, 7))
def test_numbers_follow_the_order(spark, ids, partitions):
    df = spark.createDataFrame([(i,) for i in ids], "id bigint")
    got = rows(positions.numbered(df, [F.col("id").desc()], "n", partitions), "n", "id")
    assert got == [(n + 1, i) for n, i in enumerate(sorted(ids, reverse=True))]


def test_surrogate_keys_follow_the_largest(spark):
    existing = spark.createDataFrame([(7,), (3,)], "id bigint")
    new = spark.createDataFrame([("b",), ("a",), ("c",)], "name string")
    keyed = positions.surrogate_keys(new, existing, "id", [F.col("name")])
    assert rows(keyed, "id", "name") == [(8, "a"), (9, "b"), (10, "c")]
    none = existing.filter("id < 0")
    assert rows(positions.surrogate_keys(new, none, "id", [F.col("name")]), "id", "name")[0] == (1, "a")


def test_slices_cover_distinct_ids(spark):
    df = spark.createDataFrame([(f"D{i % 25:02d}",) for i in range(100)], "number string")
    slices = positions.id_slices(df, "number", 10).orderBy("slice_no").collect()
    assert [len(s.ids) for s in slices] == [10, 10, 5]
    assert [i for s in slices for i in s.ids] == [f"D{i:02d}" for i in range(25)]


def test_chunk_key_is_unique_and_checked(spark):
    df = spark.createDataFrame([(1, 1), (1, 2), (2, 1)], "d bigint, p int")
    keys = [r[0] for r in df.select(positions.chunk_key(F.col("d"), F.col("p"))).collect()]
    assert len(set(keys)) == 3
    bad = spark.createDataFrame([(1, -1)], "d bigint, p int").select(positions.chunk_key(F.col("d"), F.col("p")))
    try:
        bad.collect()
        raise AssertionError("expected an error")
    except Exception as error:
        assert "out of range" in str(error)
