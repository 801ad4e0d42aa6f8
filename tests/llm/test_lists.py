"""Lists, blocks and turns of the Jaccard join, its number of jobs and files, and components in one task."""

import random
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from docloom.llm import graphs, jaccard_join
from docloom.staging import scratch_root, temporary
from test_pairs import components, near_copies, table


def result(spark, rows):
    got = jaccard_join.jaccard_components(table(spark, rows)).collect()
    return sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in got)


def test_lists_in_blocks_and_turns_are_exact_in_few_jobs(spark, monkeypatch):
    staged = []
    for module in (jaccard_join, graphs):
        monkeypatch.setattr(module, "stage", lambda df, label, f=module.stage: staged.append(label) or f(df, label))
    monkeypatch.setattr(jaccard_join, "FIRST_PICKS", 1, raising=False)
    monkeypatch.setattr(jaccard_join, "BLOCK", 4, raising=False)
    monkeypatch.setattr(jaccard_join, "CELLS", 64, raising=False)
    monkeypatch.setattr(jaccard_join, "BEST", (1, 2, None), raising=False)
    rows = near_copies(9, 2, 30, length=50, edits=6)
    assert result(spark, rows) == components(rows)
    assert len(staged) <= 40


@pytest.mark.parametrize("at_once", [0, 1000])
def test_components_in_one_task(spark, at_once):
    rng = random.Random(3)
    edges = [(rng.randrange(200), rng.randrange(200)) for _ in range(150)] + [(500 + i, 501 + i) for i in range(40)] + [(900, 900), (None, 3)]
    root = {x: x for e in edges if None not in e for x in e}
    for _ in root:
        for a, b in edges:
            if a is not None:
                root[a] = root[b] = min(root[a], root[b])
    frame = spark.createDataFrame(edges, "a long, b long")
    assert {r.node: r.root for r in graphs.connected_components(frame, at_once).collect()} == root


def test_shared_bits_counts_rare_and_common_numbers(monkeypatch):
    rng = np.random.default_rng(5)
    bits, owner = rng.integers(0, 40, 300), np.sort(rng.integers(0, 12, 300))
    want = [[sum((bits[owner == j] == b).sum() for b in bits[owner == i]) for j in range(12)] for i in range(12)]
    monkeypatch.setattr(jaccard_join, "CELLS", 64)
    for rare in (0, 6, 100):
        monkeypatch.setattr(jaccard_join, "RARE", rare, raising=False)
        got = jaccard_join._shared_bits(bits, owner, 12)
        assert all(got[i][j] == want[i][j] for i in range(12) for j in range(12) if i != j)


def test_a_pivot_travels_as_two_bytes():
    pivots = pa.array([[1 << 58 | 70_000, 1 << 59 | 5], [9]], pa.list_(pa.int64()))
    batch = pa.RecordBatch.from_arrays([pa.array([1, 2]), pa.array([3, 4]), pivots], ["key", "text_key", "pivots"])
    ends = next(jaccard_join._ends(iter([batch]))).column(2).to_pylist()
    assert [len(e) for e in ends] == [12, 10] and int.from_bytes(ends[0][:8], "little") == 1 << 59 | 5


def test_pivots_of_all_sets_go_before_regions_are_joined(spark, monkeypatch):
    folder, left = Path(scratch_root(spark).removeprefix("file:")), []
    before = set(folder.iterdir())

    def joined(*args, f=jaccard_join._join_regions):
        left.extend(p.name.split("-")[1] for p in set(folder.iterdir()) - before)
        return f(*args)

    monkeypatch.setattr(jaccard_join, "_join_regions", joined)
    rows = near_copies(11, 3, 4)
    assert result(spark, rows) == components(rows)
    assert "regions" in left and not {"homes", "members"} & set(left)


def test_shuffle_files_are_to_go_with_their_query_inside_a_block_only(spark):
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    with temporary(spark):
        with temporary(spark):
            assert spark.conf.get(name) == "true"
        assert spark.conf.get(name) == "true"
    assert spark.conf.get(name, None) == before


def test_filter_and_what_follows_share_a_worker(spark):
    pivots = spark.createDataFrame([(k, k + 1, [k, 70_000 + k]) for k in range(50)], "key long, text_key long, pivots array<long>")
    keys = pivots.select("key").filter("key % 7 = 0")
    got = jaccard_join._only(pivots, keys, jaccard_join._ends, "key long, text_key long, ends binary")
    assert got._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 1
    assert sorted(r.key for r in got.collect()) == [k for k in range(50) if k % 7 == 0] and len(got.first().ends) == 12
