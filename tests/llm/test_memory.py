"""What a Python worker holds at once: blocks of texts, batches of long rows, and what a leak search leaves behind."""

import tracemalloc
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from docloom.llm import decontaminate, jaccard_join, secret_scan
from docloom.llm.wordhash import shingle_sets
from docloom.staging import scratch_root, stage, temporary
from pyspark.sql import functions as F

NO_WINDOW = np.zeros(64, dtype=np.uint64)


def _sets(batch):
    return sum(len(found) for _, found in shingle_sets(batch.column(1)))


def _leaks(batch):
    return sum(b.num_rows for b in decontaminate._window_tasks(NO_WINDOW, (decontaminate.WINDOW,))(iter([batch])))


@pytest.mark.parametrize("work", [_sets, _leaks])
def test_texts_of_a_batch_are_not_all_in_work_at_once(work):
    rng = np.random.default_rng(4)
    texts = [" ".join(f"w{x}" for x in rng.integers(0, 30_000, 400)) for _ in range(1200)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(1200)), pa.array(texts)], ["key", "text"])
    work(batch.slice(0, 200))  # tables that are kept between calls
    tracemalloc.start()
    work(batch)
    peak = tracemalloc.get_traced_memory()[1] / 1e6
    tracemalloc.stop()
    assert batch.nbytes > 2.5e6 and peak < 25, peak


def test_long_rows_travel_a_few_at_a_time(spark):
    def sizes_of(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows]), pa.array([batch.nbytes])], ["rows", "size"])

    rows = spark.range(0, 400, 1, 1).select(F.repeat(F.col("id").cast("string"), 20_000).alias("text"))
    with temporary(spark):
        sizes = rows.mapInArrow(sizes_of, "rows long, size long").collect()
        short = spark.range(0, 5000, 1, 1).mapInArrow(sizes_of, "rows long, size long").collect()
    assert sum(r.rows for r in sizes) == 400 and max(r.size for r in sizes) < 6e6 < sum(r.size for r in sizes)
    assert [r.rows for r in short] == [5000]


def test_lists_may_be_cut_into_any_batches():
    rng, rows = np.random.default_rng(9), []
    for region in range(6):
        common = rng.integers(0, 60_000, 40)
        for k in range(int(rng.integers(1, 9))):
            bits = np.sort(np.concatenate([common[:30 + k], rng.integers(0, 60_000, 3)]).astype(np.uint16))
            rows.append((region, 100 * region + k, 60 + k, 0, 100 * region + k, (1 << 40).to_bytes(8, "little") + bits.tobytes()))
    kinds = [pa.int64()] * 5 + [pa.binary()]
    whole = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds, strict=True)], ["region", "key", "n", "side", "comp", "ends"])

    def found(cut):
        parts = [whole.slice(a, cut) for a in range(0, len(rows), cut)]
        return sorted(tuple(r.values()) for b in jaccard_join._list_tasks(75, None, True)(iter(parts)) for r in b.to_pylist())

    assert found(len(rows)) and all(found(cut) == found(len(rows)) for cut in (1, 2, 5))


def test_a_leak_search_leaves_its_result_alone(spark):
    folder = Path(scratch_root(spark).removeprefix("file:"))
    before = set(folder.iterdir())
    text = "the quick committee reviewed several long proposals about water before lunch and then voted twice"
    docs = spark.createDataFrame([(1, f"well {text} indeed"), (2, "nothing of the kind")], "doc_id long, text string")
    leaks = decontaminate.find_leaks(docs, spark.createDataFrame([(7, text)], "item_id long, text string"))
    assert {p.name.split("-")[0] for p in set(folder.iterdir()) - before} == {"leaks"}
    assert [r.item_id for r in leaks.collect()] == [7]


def test_sets_are_measured_by_one_worker_a_task(spark):
    sets = spark.createDataFrame([(k, np.arange(k, k + 9, dtype=np.uint64).tobytes()) for k in range(40)], "key long, shingles binary")
    sets = stage(sets, "test-sets")
    pairs = spark.createDataFrame([(k, k + 1, 9, 9) for k in range(30)], "x long, y long, nx long, ny long")
    pairs = stage(pairs, "test-pairs")  # files of known size, small enough to be broadcast

    class Kept:
        def of(self, keys):
            return jaccard_join._only(sets, keys)

    measured = jaccard_join._exact(pairs, Kept(), 75)
    plan = measured._jdf.queryExecution().executedPlan().toString()
    above = plan[plan.index("MapInArrow") + 1:]
    assert "SortMergeJoin" in above[:above.index("MapInArrow")]
    assert sorted((r.x, r.most, r.linked) for r in measured.collect()) == [(k, 8, True) for k in range(30)]


def test_a_scan_takes_no_rows_through_python(spark, monkeypatch):
    def refused(*args, **kwargs):
        raise AssertionError("rows from the driver")

    docs = spark.createDataFrame([("password = hunter2hunter2",), ("none here",), (None,)], "text string")
    monkeypatch.setattr(type(spark), "createDataFrame", refused)
    ledger, findings = secret_scan.scan(docs)
    again, same = secret_scan.scan(docs, ledger)
    assert ledger.count() == 3 * len(secret_scan.RULES) - ledger.filter("blob IS NULL").count() and again.isEmpty()
    assert findings.collect() == same.collect() and findings.count() == 1
