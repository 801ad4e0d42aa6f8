"""Substring dedup over sliding sentence spans: every repeated span is kept once in the corpus.

A sentence ends behind a word that ends in ``.``, ``!`` or ``?``, at a line break, and at the end of the text. A span is
the shortest run of at least ``SENTENCES`` sentences with ``WORDS`` words, one for every sentence it can begin with
and one for every sentence it can end with: between them they cover every sentence of a repeated run of that length.
All spans are hashed and joined over the whole corpus; the first occurrence (least doc_id, then position)
stays, and every sentence that another occurrence covers is removed.

The first occurrence is an aggregate, combined before the shuffle and staged; a filter of fixed size over the
repeated hashes keeps unrepeated spans out of the join back. A span that a third of all rows share is split.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom.llm.graphs import bit_filter, may_contain
from docloom.llm.registry import query
from docloom.llm.wordhash import _powers, mix, span_hashes, text_blocks, word_bounds
from docloom.staging import stage

SENTENCES, WORDS = 2, 20
FILTER_BITS = 1 << 25

_END = np.zeros(256, dtype=bool)
_END[[33, 46, 63]] = True


def sentences(data: np.ndarray, offsets: np.ndarray):
    """(word starts, word ends, word hashes, first word of each sentence and one more, text of each sentence)."""
    starts, ends, first = word_bounds(data, offsets)
    if not len(starts):
        return starts, ends, np.zeros(0, np.uint64), np.zeros(1, np.int64), np.zeros(0, np.int64)
    hashes = span_hashes(data, starts, ends)
    breaks = np.concatenate([[0], np.cumsum(data == 10)])
    new = np.zeros(len(starts) + 1, dtype=bool)
    new[first] = True
    new[1:-1] |= _END[data[ends[:-1] - 1]] | (breaks[starts[1:]] > breaks[ends[:-1]])
    heads = np.flatnonzero(new[:-1])
    owner = np.searchsorted(first, heads, side="right") - 1
    return starts, ends, hashes, np.append(heads, len(starts)), owner


def spans(hashes: np.ndarray, heads: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first sentence, number of sentences, hash) of every span, each once."""
    first = np.arange(len(owner))
    last = np.maximum(first + SENTENCES, np.searchsorted(heads, heads[:-1] + WORDS))  # one behind the last sentence
    end = first + 1
    begin = np.minimum(end - SENTENCES, np.searchsorted(heads, heads[1:] - WORDS, side="right") - 1)
    other = begin >= 0
    other[other] = last[begin[other]] != end[other]  # not the run that begins there as well
    first, last = np.concatenate([first, begin[other]]), np.concatenate([last, end[other]])
    fits = last <= len(owner)
    fits[fits] = owner[last[fits] - 1] == owner[first[fits]]
    first, last = first[fits], last[fits]
    up, down = _powers(len(hashes))
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(hashes * up[:len(hashes)])])
    a, b = heads[first], heads[last]
    return first, last - first, mix((sums[b] - sums[a]) * down[a] + (b - a).astype(np.uint64))


def _span_tasks(wanted: np.ndarray | None):
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, data, offsets in text_blocks(batch.column(2)):
                _, _, hashes, heads, owner = sentences(data, offsets)
                first, count, value = spans(hashes, heads, owner)
                if wanted is not None:
                    keep = may_contain(wanted, value)
                    first, count, value = first[keep], count[keep], value[keep]
                for a in range(0, len(first), 50_000):
                    part = slice(a, a + 50_000)
                    text = owner[first[part]]
                    rows = pa.array(row + text)
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0).take(rows), batch.column(1).take(rows),
                         pa.array((first[part] - np.searchsorted(owner, text)).astype(np.int64)), pa.array(count[part].astype(np.int32)),
                         pa.array(value[part].view(np.int64))], ["doc_id", "text_key", "pos", "n", "hash"])

    return emit


_SPANS = "doc_id long, text_key long, pos long, n int, hash long"


def repeated_spans(docs: DataFrame) -> DataFrame:
    """(doc_id, text_key, cover array<struct<pos, n>>): the non-first spans of every text that has some. Staged."""
    keyed = docs.select("doc_id", F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_key"), "text")
    place = F.struct(F.col("doc_id").isNull().alias("last"), F.coalesce("doc_id", F.lit(0)).alias("doc"), "text_key", "pos")
    every = keyed.mapInArrow(_span_tasks(None), _SPANS)
    firsts = every.groupBy("hash").agg(F.min(place).alias("low"), F.max(place).alias("high")).filter("low <> high")
    firsts = stage(firsts.select(F.col("hash").alias("h"), F.col("low.last").alias("fl"), F.col("low.doc").alias("fd"),
                                 F.col("low.text_key").alias("fk"), F.col("low.pos").alias("fp")), "span-firsts")
    again = keyed.mapInArrow(_span_tasks(bit_filter(firsts, "h", FILTER_BITS)), _SPANS)
    first = F.expr("(doc_id IS NULL) = fl AND coalesce(doc_id, 0) = fd AND text_key = fk AND pos = fp")
    others = stage(again.join(firsts, F.col("hash") == F.col("h")).filter(~first).select("doc_id", "text_key", "pos", "n").distinct(), "span-others")
    # The list is bounded by the sentences of one text.
    return stage(others.groupBy("doc_id", "text_key").agg(F.array_sort(F.collect_list(F.struct("pos", "n"))).alias("cover")), "span-cover")


def _cut_tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out, removed, ranges = [], [], []
        for text, cover in zip(batch.column(1), batch.column(2), strict=True):
            raw = (text.as_py() or "").encode()
            data = np.frombuffer(raw, dtype=np.uint8)
            starts, ends, _, heads, owner = sentences(data, np.array([0, len(data)]))
            gone = np.zeros(len(owner) + 1, dtype=np.int64)
            for span in cover.as_py():
                gone[span["pos"]] += 1
                gone[span["pos"] + span["n"]] -= 1
            gone = np.cumsum(gone[:-1]) > 0
            edges = np.append(starts[heads[:-1]], len(data))
            kept, at, spans_here = [raw[:edges[0]]], 0, []
            while at < len(gone):
                end = at
                while end < len(gone) and gone[end] == gone[at]:
                    end += 1
                if gone[at]:
                    spans_here.append({"start": len(raw[:edges[at]].decode()), "end": len(raw[:ends[heads[end] - 1]].decode())})
                else:
                    kept.append(raw[edges[at]:edges[end]])
                at = end
            out.append(b"".join(kept).decode())
            removed.append(int(gone.sum()))
            ranges.append(spans_here)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(removed, pa.int64()), pa.array(
            ranges, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))), pa.array(out, pa.string())], ["doc_id", "n_removed", "spans", "text"])


def dedup_spans(docs: DataFrame) -> DataFrame:
    """(doc_id, n_removed, spans, text) of every row of ``docs`` (doc_id, text) that loses a sentence; others stay as they are.

    ``spans`` are code-point ranges of the old text, ``text`` is what is left. Rows with the same doc_id and text are one
    document and keep their first occurrences together; NULL doc_ids come last in the order. NULL, empty and
    one-sentence texts have no span. Other columns are ignored. An empty table gives an empty one.
    """
    cover = repeated_spans(docs).select(F.col("doc_id").alias("_d"), F.col("text_key").alias("_k"), "cover")
    same = F.col("doc_id").eqNullSafe(F.col("_d")) & (F.xxhash64(F.coalesce("text", F.lit(""))) == F.col("_k"))
    hit = docs.select("doc_id", "text").join(cover, same).select("doc_id", "text", "cover")
    return hit.mapInArrow(_cut_tasks, "doc_id long, n_removed long, spans array<struct<start: long, end: long>>, text string")


@query()
def op7_sentence_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_spans(spark.read.parquet(f"{sf_dir}/documents.parquet"))
