"""Connected components and fixed-size bit filters as DataFrame work."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docloom.staging import stage

BITS = 1 << 24


def _solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Nodes and least reachable nodes of all edges of a task: labels fall along edges, then each takes its label's label."""
    parts = [np.stack([batch.column(0).to_numpy(), batch.column(1).to_numpy()]) for batch in batches if batch.num_rows]
    if not parts:
        return
    nodes, at = np.unique(np.concatenate(parts, axis=1), return_inverse=True)
    x, y = at.reshape(2, -1)
    label, before = np.arange(len(nodes)), None
    while before is None or (label != before).any():
        before = label.copy()
        least = np.minimum(before[x], before[y])
        for ends in (x, y, before[x], before[y]):
            np.minimum.at(label, ends, least)
        label = label[label]
    for a in range(0, len(nodes), 1 << 16):
        part = slice(a, a + (1 << 16))
        yield pa.RecordBatch.from_arrays([pa.array(nodes[part]), pa.array(nodes[label[part]])], ["node", "root"])


def connected_components(edges: DataFrame, at_once: int = 0) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b): ``root`` is the least node of its component.

    Alternates two star steps until nothing moves: each node hands its larger neighbours, then its smaller
    ones, to the least it knows. Rounds grow with the logarithm of the longest chain. A hub's neighbours
    are never gathered: the least is an aggregate, combined before the shuffle and staged, so the join back
    may broadcast it or split the hub. Every round is written to the shared scratch folder, which cuts the
    lineage. Self-loops, repeats, either direction and NULLs are allowed; a NULL end drops its edge. A node
    seen only in a self-loop is its own root. An empty table gives an empty one.

    ``at_once``: so many edges at most are solved in one task, in one job instead of several a round. The result is the same.
    """
    edges = edges.select("a", "b").filter("a IS NOT NULL AND b IS NOT NULL")
    if at_once and edges.count() <= at_once:
        return stage(edges.coalesce(1).mapInArrow(_solve, "node long, root long"), "cc-roots")
    nodes = edges.select(F.col("a").alias("node")).union(edges.select("b")).distinct()
    current = stage(_oriented(edges), "cc-edges")
    before = None
    while True:
        seen = current.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if seen[0] == 0 or tuple(seen) == before:
            break
        before = tuple(seen)
        both = current.union(current.select("b", "a"))
        least = stage(both.groupBy(F.col("a").alias("u")).agg(F.min("b").alias("m")), "cc-least")
        large = both.filter("b > a").join(least, F.col("a") == F.col("u"))
        current = stage(_oriented(large.select(F.col("b").alias("a"), F.least("a", "m").alias("b"))), "cc-large")
        least = stage(current.groupBy(F.col("a").alias("u")).agg(F.min("b").alias("m")), "cc-least")
        small = current.join(least, F.col("a") == F.col("u")).select(F.col("b").alias("a"), F.col("m").alias("b"))
        current = stage(_oriented(small.union(least.select("u", "m"))), "cc-small")
    roots = current.select(F.col("a").alias("_n"), F.col("b").alias("_r"))
    return stage(nodes.join(roots, F.col("node") == F.col("_n"), "left")
                 .select("node", F.coalesce("_r", "node").alias("root")), "cc-roots")


def _oriented(edges: DataFrame) -> DataFrame:
    return edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def bit_filter(keys: DataFrame, column: str, bits: int = BITS) -> np.ndarray:
    """A filter of exactly ``bits`` bits in which the bit of every key is set: no key is ever missed.

    Its size does not depend on the data (2 MB by default), so it may be sent to all tasks. With many keys
    it lets more strangers pass; the join that follows decides, so results stay the same.
    """
    cell = F.col(column).bitwiseAND(F.lit(bits - 1))
    words = (keys.select(F.shiftright(cell, 6).alias("word"), cell.bitwiseAND(63).cast("int").alias("bit"))
             .groupBy("word").agg(F.bit_or(F.expr("shiftleft(1L, bit)")).alias("mask")).toArrow())
    out = np.zeros(bits // 64, dtype=np.int64)
    out[words["word"].to_numpy()] = words["mask"].to_numpy()
    return out.view(np.uint64)


def may_contain(filter_words: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    cell = hashes & np.uint64(len(filter_words) * 64 - 1)
    return (filter_words[cell >> np.uint64(6)] >> (cell & np.uint64(63))) & np.uint64(1) != 0
