import pytest
from conftest import rows
from docloom.operators.merge import Delete, Insert, Update, change_set, merge, publish, replace_by_key, update_column
from docloom.sources.writers import create_tables
from docloom.staging import scratch_path
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F


def frame(spark, data, schema="k int, v int, t string"):
    return spark.createDataFrame(data, schema)


def set_v():
    return Update({"v": F.col("src.v")})


def test_update_and_insert(spark):
    target = frame(spark, [(1, 10, "a"), (2, 20, "b"), (None, 5, "n")])
    source = frame(spark, [(2, 99, "x"), (3, 30, "y"), (None, 7, "m")])
    merged = merge(target, source, ["k"], [set_v()], Insert())
    assert rows(merged) == [(None, 5, "n"), (None, 7, "m"), (1, 10, "a"), (2, 99, "b"), (3, 30, "y")]


def test_update_can_write_null(spark):
    merged = merge(frame(spark, [(1, 10, "a")]), frame(spark, [(1, None, "x")]), ["k"], [set_v()])
    assert rows(merged) == [(1, None, "a")]


def test_duplicate_source_rows_fail_when_they_match(spark):
    target, source = frame(spark, [(1, 10, "a")]), frame(spark, [(1, 1, "x"), (1, 2, "y")])
    merged = merge(target, source, ["k"], [set_v()])
    with pytest.raises(Exception, match="several source rows"):
        merged.select("t").collect()


def test_duplicate_source_rows_are_all_inserted(spark):
    source = frame(spark, [(9, 1, "x"), (9, 1, "x")])
    merged = merge(frame(spark, [(1, 10, "a")]), source, ["k"], [set_v()], Insert())
    assert rows(merged) == [(1, 10, "a"), (9, 1, "x"), (9, 1, "x")]


def test_one_source_row_updates_every_match(spark):
    merged = merge(frame(spark, [(1, 1, "a"), (1, 2, "b")]), frame(spark, [(1, 7, "x")]), ["k"], [set_v()])
    assert rows(merged) == [(1, 7, "a"), (1, 7, "b")]


def test_condition_is_strict_and_null_does_nothing(spark):
    target = frame(spark, [(1, 5, "a"), (2, 5, "b"), (3, None, "c")])
    source = frame(spark, [(1, 6, "x"), (2, 5, "y"), (3, 9, "z")])
    newer = Update({"t": F.col("src.t")}, when=F.col("tgt.v") < F.col("src.v"))
    assert rows(merge(target, source, ["k"], [newer])) == [(1, 5, "x"), (2, 5, "b"), (3, None, "c")]


def test_first_clause_wins(spark):
    target = frame(spark, [(1, 1, "a"), (2, 2, "b"), (3, 3, "c")])
    source = frame(spark, [(1, 0, "x"), (2, 0, "y")])
    clauses = [Update({"t": F.lit("kept")}, when=F.col("tgt.v") == 1), Delete()]
    assert rows(merge(target, source, ["k"], clauses)) == [(1, 1, "kept"), (3, 3, "c")]


def test_delete_allows_repeated_source_keys(spark):
    target = frame(spark, [(1, 1, "a"), (1, 2, "b"), (2, 3, "c"), (None, 4, "d")])
    source = frame(spark, [(1, 0, "x"), (1, 0, "y"), (None, 0, "z")])
    assert rows(merge(target, source, ["k"], [Delete()])) == [(None, 4, "d"), (2, 3, "c")]


def test_insert_defaults_and_condition(spark):
    target = frame(spark, [(1, 1, "a")])
    source = spark.createDataFrame([(2,), (3,)], "k int")
    insert = Insert(when=F.col("k") > 2, defaults={"t": "'PENDING'"})
    assert rows(merge(target, source, ["k"], not_matched=insert)) == [(1, 1, "a"), (3, None, "PENDING")]


def test_composite_key(spark):
    target = frame(spark, [(1, 1, "a"), (1, 2, "b"), (1, None, "c")])
    source = frame(spark, [(1, 2, "x"), (2, 1, "y"), (1, None, "z")])
    merged = merge(target, source, ["k", "v"], not_matched=Insert())
    assert rows(merged) == [(1, None, "c"), (1, None, "z"), (1, 1, "a"), (1, 2, "b"), (2, 1, "y")]


_ROWS = st.dictionaries(st.integers(0, 6), st.integers(0, 3), max_size=6)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(_ROWS, _ROWS)
def test_upsert_equals_dict_update_and_repeats_without_change(spark, old, new):
    def make(d):
        return frame(spark, [(k, v, "r") for k, v in d.items()])

    target, source = make(old), make(new)
    merged = merge(target, source, ["k"], [set_v()], Insert())
    assert {r[0]: r[1] for r in merged.collect()} == {**old, **new}
    assert rows(merge(merged, source, ["k"], [set_v()], Insert())) == rows(merged)


def test_update_column_stamps_only_matches(spark):
    at = F.lit("2024-01-01").cast("timestamp")
    target = spark.createDataFrame([(1, "PENDING"), (2, "PENDING")], "k int, s string").withColumn(
        "audit__updated_date", at)
    source = spark.createDataFrame([(2, "COMPLETED")], "k int, status string")
    later = F.lit("2024-02-02").cast("timestamp")
    result = update_column(target, source, "k", "s", "status", later)
    shown = result.withColumn("d", F.date_format("audit__updated_date", "MM-dd"))
    assert rows(shown, "k", "s", "d") == [(1, "PENDING", "01-01"), (2, "COMPLETED", "02-02")]


def test_replace_by_key(spark):
    target = frame(spark, [(1, 1, "a"), (1, 2, "b"), (2, 3, "c")])
    source = spark.createDataFrame([(1, 9), (1, 8), (5, 7)], "k int, v int")
    replaced = replace_by_key(target, source, "k", {"t": "'new'"})
    assert rows(replaced) == [(1, 8, "new"), (1, 9, "new"), (2, 3, "c"), (5, 7, "new")]


def test_change_set_sees_nulls_and_rebuilds_the_new_state(spark):
    before = frame(spark, [(1, 1, "a"), (2, None, "b"), (3, 3, "c"), (4, 4, None)])
    after = frame(spark, [(1, 1, "a"), (2, 2, "b"), (4, 4, None), (5, 5, "e")])
    changes = change_set(before, after, "k", ["v", "t"])
    assert rows(changes) == [(2, "update", 2, "b"), (3, "delete", 3, "c"), (5, "insert", 5, "e")]
    kept = before.join(changes, "k", "left_anti")
    assert rows(kept.unionByName(changes.filter("change_type <> 'delete'").drop("change_type"))) == rows(after)


def test_publish_replaces_a_table_read_by_its_own_update(spark):
    spark.sql(f"CREATE DATABASE IF NOT EXISTS pub LOCATION '{scratch_path(spark, 'pub')}'")
    frame(spark, [(1, 1, "a"), (2, 2, "b")]).write.mode("overwrite").saveAsTable("pub.things")
    for expected in (11, 21):
        publish(spark.table("pub.things").withColumn("v", F.col("v") + 10), "pub.things")
        assert rows(spark.table("pub.things"), "v")[0] == (expected,)


def test_bucketed_tables_join_without_a_shuffle(spark):
    spark.sql(f"CREATE DATABASE IF NOT EXISTS bkt LOCATION '{scratch_path(spark, 'bkt')}'")
    create_tables(spark, "bkt", buckets=4)
    ids = spark.range(100).select(F.col("id").alias("metadata_id"))
    for table in ("docs_metadata", "docs_embeddings"):
        empty = spark.table(f"bkt.{table}")
        publish(merge(empty, ids, ["metadata_id"], not_matched=Insert()), f"bkt.{table}", bucket=(4, "metadata_id"))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = spark.table("bkt.docs_embeddings").join(spark.table("bkt.docs_metadata"), "metadata_id")
        assert joined.count() == 100
        assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_nested_values_from_storage_meet_a_target_that_forbids_null_inside(spark):
    def nested(k, v):
        return spark.range(1).select(F.lit(k).alias("k"), F.array(F.struct(F.lit(v).alias("n"))).alias("pages"))

    path = scratch_path(spark, "nested")
    nested(1, 7).unionByName(nested(2, 8)).write.parquet(path)
    source, target = spark.read.parquet(path), nested(1, 5)
    merged = merge(target, source, ["k"], [Update({"pages": F.col("src.pages")})], Insert())
    assert rows(merged.selectExpr("k", "pages[0].n")) == [(1, 7), (2, 8)]
    assert rows(replace_by_key(target, source, "k").selectExpr("k", "pages[0].n")) == [(1, 7), (2, 8)]
