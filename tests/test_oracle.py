"""Every query against its DuckDB text on the smallest tables."""

import __spark_entry__ as entry
import pytest
from oracle_check import compare, connect


@pytest.fixture(scope="module")
def duck(small):
    return connect(small)


# The training-data queries have tests of their own beside them.
@pytest.mark.parametrize("name", sorted(n for n in entry.queries() if n != "pipeline" and not n.startswith("op")))
def test_query(spark, small, duck, name):
    frame = entry.queries()[name](spark, small)
    sql = entry.oracle_sql().get(name)
    if sql is None:
        assert frame.count() > 0
    else:
        assert compare(frame, duck, sql) in (None, "empty result")


def test_entry(spark, small):
    assert entry.entry(spark).columns == ["question_id", "context"]


@pytest.mark.parametrize("name", ["version_rank", "id_slices", "bm25_topk", "merge_conditional", "chat_history_text"])
def test_results_do_not_depend_on_partitions(spark, small, duck, name):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "3")
        assert compare(entry.queries()[name](spark, small), duck, entry.oracle_sql()[name]) is None
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
