"""Regions beyond 4,096 members, as whole tables of several GB have them, are lists too, and their pairs leave a task in portions."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from docloom.llm import jaccard_join
from docloom.staging import stage


def _members(count: int) -> pa.Table:
    rng = np.random.default_rng(3)
    ends = [int(rng.integers(1, 1 << 60)).to_bytes(8, "little") + np.sort(rng.integers(0, 1 << 16, 3).astype(np.uint16)).tobytes() for _ in range(count)]
    return pa.table({"region": np.ones(count, np.int64), "key": np.arange(count), "n": np.full(count, 9, np.int64), "side": np.zeros(count, np.int32),
                     "comp": np.arange(count), "ends": pa.array(ends, pa.binary())})


def test_a_region_of_5000_needs_no_document_pivots(spark, monkeypatch):
    def never(*_):
        raise AssertionError("a region of 5,000 members went through document pivots")

    class NoSets:
        parts: list = []

        def of(self, keys):
            return spark.createDataFrame([], "key long, shingles binary")

    members = spark.createDataFrame(_members(5000))
    none = spark.createDataFrame([], "a long, b long")
    monkeypatch.setattr(jaccard_join, "_next_regions", never)
    monkeypatch.setattr(jaccard_join, "_first_links", lambda regions, *_: (none, regions))
    regions = stage(members.select("region", "key", "n", "side", "comp"), "test-regions")
    firsts = stage(members.select("key", "ends"), "test-firsts")
    assert jaccard_join._join_regions(regions, firsts, NoSets(), 75).count() == 0


def test_pairs_of_a_list_leave_in_portions(monkeypatch):
    rows = _members(1500)
    ends = [rows["ends"][0].as_py()] * rows.num_rows  # all may be linked with all
    rows = rows.set_column(5, "ends", pa.array(ends, pa.binary()))
    monkeypatch.setattr(jaccard_join, "PAIRS_OUT", 50_000, raising=False)
    out = list(jaccard_join._list_tasks(75, None, True)(iter(rows.to_batches())))
    assert sum(b.num_rows for b in out) == 1500 * 1499 // 2
    assert max(b.num_rows for b in out) < 50_000 + 256 * 256
    pairs = pa.Table.from_batches(out).to_pandas()
    assert len(pairs[["x", "y"]].drop_duplicates()) == len(pairs) and (pairs["x"] < pairs["y"]).all()
