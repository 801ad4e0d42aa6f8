"""Conflict-constrained best-fit packing of documents into bins of a fixed number of words.

Two pieces of one duplicate cluster, or of one source, never share a bin. Pieces are dealt by a stored salt
into groups of about ``GROUP`` pieces, so a hot source or a cluster of copies spreads over all groups, and
each group is packed on its own: longest first, into the tightest open bin that has room and no conflict.
Bins are kept in order of what is left in them and carry their sources and clusters as bitmaps; the search
starts at the first bin with room and walks to the next until a bin fits, so its cost is bounded by the group.
"""

from __future__ import annotations

from bisect import bisect_left, insort

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom.llm.registry import query
from docloom.staging import stage

CAPACITY, GROUP = 2048, 4096


def best_fit(sizes: list[int], sources: list[int], clusters: list[int], capacity: int) -> tuple[list[int], list[int]]:
    """Bin and offset of every item, taken in the given order. ``sources`` and ``clusters`` are small codes; a negative cluster has no copy."""
    left: list[tuple[int, int]] = []  # (room, bin), ascending: the tightest first
    source_bits: list[int] = []
    cluster_bits: list[int] = []
    bins, offsets = [], []
    for size, source, cluster in zip(sizes, sources, clusters, strict=True):
        source_bit, cluster_bit = 1 << source, 1 << cluster if cluster >= 0 else 0
        at = bisect_left(left, (size, -1))
        while at < len(left) and (source_bits[left[at][1]] & source_bit or cluster_bits[left[at][1]] & cluster_bit):
            at += 1
        if at < len(left):
            room, chosen = left.pop(at)
        else:
            room, chosen = capacity, len(source_bits)
            source_bits.append(0)
            cluster_bits.append(0)
        source_bits[chosen] |= source_bit
        cluster_bits[chosen] |= cluster_bit
        bins.append(chosen)
        offsets.append(capacity - room)
        if room > size:
            insort(left, (room - size, chosen))
    return bins, offsets


def _pack_group(capacity: int):
    def pack(table: pa.Table) -> pa.Table:
        table = table.sort_by([("n_words", "descending"), ("cluster", "ascending"), ("salt", "ascending")])
        sources = table["source"].combine_chunks().dictionary_encode(null_encoding="encode").indices.to_pylist()
        clusters = table["cluster"].to_numpy()
        _, code, copies = np.unique(clusters, return_inverse=True, return_counts=True)
        shared = np.cumsum(copies > 1) - 1  # only clusters with a copy in this group need a bit
        codes = np.where(copies[code] > 1, shared[code], -1).tolist()
        bins, offsets = best_fit(table["n_words"].to_pylist(), sources, codes, capacity)
        base = table["pack_group"][0].as_py() << 32
        return pa.table({"doc_id": table["doc_id"], "piece": table["piece"], "n_words": table["n_words"], "cluster": table["cluster"],
                         "source": table["source"], "bin_id": pa.array([base + b for b in bins], pa.int64()), "bin_offset": pa.array(offsets, pa.int64())})

    return pack


def pack_documents(docs: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """One row per piece: doc_id, piece, n_words, cluster, source, bin_id, bin_offset.

    A document longer than ``capacity`` words is cut into whole bins and a rest. ``cluster`` is a hash of the
    lower-cased words, so copies that differ in case or white space count as one cluster. NULL, empty and
    blank texts take no room: one row with 0 words and NULL bin. NULL sources are one source; NULL doc_ids and
    repeated rows are packed like others. Other columns are ignored. An empty table gives an empty one.
    """
    words = F.regexp_replace(F.lower(F.trim(F.regexp_replace(F.coalesce("text", F.lit("")), r"[\x20\x09-\x0D]+", " "))), "^$", "")
    sized = docs.select("doc_id", "source", words.alias("w")).select(
        "doc_id", "source", F.xxhash64("w").alias("cluster"),
        F.when(F.col("w") == "", 0).otherwise(F.length("w") - F.length(F.replace("w", F.lit(" "))) + 1).cast("long").alias("total"))
    pieces = sized.withColumn("piece", F.explode(F.sequence(F.lit(0), F.greatest(F.lit(0), F.ceil(F.col("total") / capacity) - 1).cast("int"))))
    pieces = stage(pieces.select(
        "doc_id", "source", "cluster", "piece", F.least(F.lit(capacity), F.col("total") - F.col("piece") * capacity).alias("n_words"),
        F.xxhash64("doc_id", "cluster", "piece", F.monotonically_increasing_id()).alias("salt")), "pack-pieces")
    filled = pieces.filter("n_words > 0")
    groups = max(1, -(-filled.count() // GROUP))
    schema = "doc_id long, piece int, n_words long, cluster long, source string, bin_id long, bin_offset long"
    packed = filled.withColumn("pack_group", F.pmod("salt", F.lit(groups))).groupBy("pack_group").applyInArrow(_pack_group(capacity), schema)
    none = F.lit(None).cast("long")
    return packed.union(pieces.filter("n_words = 0").select("doc_id", "piece", "n_words", "cluster", "source", none, none))


@query()
def op8_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"))
