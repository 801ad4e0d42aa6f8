"""Benchmark decontamination by template windows: canonical tokens, hash join, slot consistency.

Numbers, names and units become typed placeholders, so a benchmark question whose parameters were changed has
the same template. Windows of ``WINDOW`` canonical tokens are hashed on both sides and joined; a document and
an item then meet along a diagonal (equal distance of positions). The placeholder values of both must map one
to one over the whole diagonal: the same value in the item is the same value in the document and the other
way round. ``RUN`` windows in this agreement (13 tokens), or all of a shorter item's, make a leak.

Windows poor in plain words (fewer than ``LEAST_WORDS``) say too little as templates: they are hashed with the
values of their slots and meet only word for word. They count beside the template windows of their diagonal, and
enough of them make a leak on their own, so sums and lists of names are found when they are copied as they are.

Items with the same template and, over the whole item, the same pattern of equal slots are one family, so a hundred parametrisations
of one question cost no more than one. Before the shuffle a filter of fixed size drops document windows that no
item has; it can let strangers pass but never loses a match.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom.llm.graphs import bit_filter, may_contain
from docloom.llm.registry import query
from docloom.llm.wordhash import _LOWER, mix, span_hashes, text_blocks, windows
from docloom.staging import stage, temporary

WINDOW, RUN, LEAST_TOKENS, LEAST_WORDS = 8, 6, 5, 4
# Unit words, which count as units only right after a number.
UNITS = ("kg g mg lb lbs oz km m cm mm mi miles mile ft feet foot inch inches yd yards hour hours h minute minutes min second seconds s "
         "day days week weeks month months year years dollar dollars usd eur euro euros cent cents percent l ml liter liters litre litres "
         "gallon gallons mph kmh degrees celsius fahrenheit").split()

_DIGIT = np.zeros(256, dtype=bool)
_DIGIT[48:58] = True
_UPPER = np.zeros(256, dtype=bool)
_UPPER[65:91] = True
_TOKEN = _DIGIT.copy()
_TOKEN[65:91] = _TOKEN[97:123] = _TOKEN[128:] = True
_STOP = np.zeros(256, dtype=bool)
_STOP[[10, 13, 33, 34, 39, 40, 41, 46, 58, 59, 63]] = True  # after these a capital letter may only begin a sentence
_POINT = np.zeros(256, dtype=bool)
_POINT[[44, 46]] = True


def _unit_hashes() -> np.ndarray:
    data = np.frombuffer(" ".join(UNITS).encode(), dtype=np.uint8)
    ends = np.cumsum([len(u) + 1 for u in UNITS]) - 1
    return np.unique(span_hashes(data, ends - np.array([len(u) for u in UNITS]), ends))


def canonical(data: np.ndarray, offsets: np.ndarray, units: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(canonical hash, slot value or 0, first token of each text) of all tokens of a block of texts.

    Tokens are runs of letters, runs of digits (with points and commas between digits) and non-ASCII bytes.
    Capitals A-Z and of the Latin-1 letters are folded.
    """
    if len(data) == 0:
        none = np.zeros(0, dtype=np.uint64)
        return none, none, np.zeros(len(offsets), dtype=np.int64)
    digit, cut = _DIGIT[data], np.zeros(len(data) + 1, dtype=bool)
    cut[offsets] = True
    inside = _TOKEN[data]
    inside[1:-1] |= _POINT[data[1:-1]] & digit[:-2] & digit[2:] & ~cut[1:-2]
    number = digit | (inside & _POINT[data])
    edge = cut[1:-1] | (number[1:] != number[:-1])
    begins, ends = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1] | edge
    ends[:-1] &= ~inside[1:] | edge
    starts, ends = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    first = np.searchsorted(starts, offsets)
    folded = _LOWER[data]
    wide = np.zeros(len(data), dtype=bool)
    wide[1:] = (data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E) & (data[1:] != 0x97)
    folded[wide] += 32
    value = span_hashes(folded, starts, ends, np.arange(256, dtype=np.uint8))
    is_number = number[starts]
    stops = np.concatenate([[0], np.cumsum(_STOP[data])])
    opens = np.zeros(len(starts), dtype=bool)
    opens[first[:-1][first[:-1] < len(starts)]] = True
    after = np.ones(len(starts), dtype=bool)
    after[1:] = stops[starts[1:]] == stops[ends[:-1]]
    capital = _UPPER[data[starts]] | wide[np.minimum(starts + 1, len(data) - 1)]
    tail = np.minimum(starts + np.where(_UPPER[data[starts]], 1, 2), len(data) - 1)
    lower_tail = (ends - starts > np.where(_UPPER[data[starts]], 1, 2)) & ~_UPPER[data[tail]] & ~wide[np.minimum(tail + 1, len(data) - 1)]
    is_name = capital & lower_tail & after & ~opens & ~is_number
    behind_number = np.zeros(len(starts), dtype=bool)
    behind_number[1:] = is_number[:-1]
    is_unit = behind_number & ~opens & np.isin(value, units) if behind_number.any() else np.zeros(len(starts), dtype=bool)
    kinds = np.select([is_number, is_unit, is_name], [1, 2, 3], 0)
    return np.where(kinds > 0, kinds.astype(np.uint64), value), np.where(kinds > 0, value | np.uint64(1), np.uint64(0)), first


def first_equal(owner: np.ndarray, slots: np.ndarray, first: np.ndarray) -> np.ndarray:
    """For every token the place of the first slot with its value in the same text, from 1; 0 where there is no slot."""
    out = np.zeros(len(slots), dtype=np.int64)
    at = np.flatnonzero(slots)
    order = at[np.lexsort((at, slots[at], owner[at]))]
    new = np.ones(len(order), dtype=bool)
    new[1:] = (slots[order[1:]] != slots[order[:-1]]) | (owner[order[1:]] != owner[order[:-1]])
    out[order] = order[np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))] - first[owner[order]] + 1
    return out


def _lists(values: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.arange(len(values) + 1, dtype=np.int32) * values.shape[1]), pa.array(values.ravel().view(np.int64)))


def _window_tasks(known: np.ndarray | None, sizes: tuple[int, ...]):
    """Windows of every text: all of them, or those that may be ``known``. A text shorter than ``WINDOW`` is one window."""
    units = _unit_hashes()

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, data, offsets in text_blocks(batch.column(1)):
                tokens, slots, first = canonical(data, offsets, units)
                exact = np.where(slots == 0, tokens, slots) | np.uint64(1)  # a capital that opens a sentence here and not there is the same word
                counts = np.diff(first)
                owner = np.repeat(np.arange(len(counts)), counts)
                literal = np.concatenate([[0], np.cumsum(slots == 0)])
                same = first_equal(owner, slots, first) if known is None else None
                for size in sizes:
                    hashes = windows(tokens, size) ^ np.uint64(size)
                    exactly = mix(windows(exact, size) ^ np.uint64(size))
                    at = np.arange(len(hashes))
                    poor = literal[at + size] - literal[at] < min(LEAST_WORDS, size - 1)
                    # Inside one text; windows shorter than the usual only where asked for.
                    keep = (owner[:len(hashes)] == owner[size - 1:]) if len(hashes) else np.zeros(0, dtype=bool)
                    if known is None:
                        keep &= (counts[owner[:len(hashes)]] == size) if size < WINDOW else True
                        at = at[keep]
                        hashes, poor = np.where(poor, exactly, hashes)[at], poor[at]
                    else:
                        rich, plain = np.flatnonzero(keep & ~poor & may_contain(known, hashes)), np.flatnonzero(keep & may_contain(known, exactly))
                        at, poor = np.concatenate([rich, plain]), np.arange(len(rich) + len(plain)) >= len(rich)
                        hashes = np.concatenate([hashes[rich], exactly[plain]])
                    if not len(at):
                        continue
                    places = at[:, None] + np.arange(size)
                    columns = [batch.column(0).take(pa.array(row + owner[at])), pa.array((at - first[owner[at]]).astype(np.int64)),
                               pa.array(counts[owner[at]].astype(np.int64)), pa.array(hashes.view(np.int64)), pa.array(poor), _lists(slots[places])]
                    if same is not None:
                        columns.append(_lists(same[places]))
                    yield pa.RecordBatch.from_arrays(columns, ["id", "pos", "tokens", "hash", "poor", "slots", "same"][:len(columns)])

    return found


_SCHEMA = "id long, pos long, tokens long, hash long, poor boolean, slots array<long>"


def benchmark_windows(benchmark: DataFrame) -> DataFrame:
    """(item_id, ipos, item_windows, rich_windows, hash, poor, islots): the template windows of one item per family, and
    the windows poor in plain words of all its members, each once. ``rich_windows`` of the item's windows are templates."""
    sizes = tuple(range(LEAST_TOKENS, WINDOW + 1))
    raw = stage(benchmark.select("item_id", "text").filter("item_id IS NOT NULL AND text IS NOT NULL").dropDuplicates(["item_id"])
                .mapInArrow(_window_tasks(None, sizes), f"{_SCHEMA}, same array<long>"), "leak-items")
    # All windows of an item, in order, are its template, and ``same`` says which slots of the item are equal;
    # an item has few windows, so the list is bounded by its text. Poor windows tell items apart only where there are no others.
    whole = F.array_sort(F.collect_list(F.struct("pos", "poor", "hash", "same")))
    rich = F.count_if(~F.col("poor"))
    template = F.transform(whole, lambda x: F.struct(x["pos"], x["poor"], F.when(~x["poor"] | (rich == 0), x["hash"]).alias("hash"), x["same"]))
    family = raw.groupBy("id").agg(F.sha2(F.to_json(template), 256).alias("family"), F.count("*").alias("item_windows"), rich.alias("rich_windows"))
    family = stage(family, "leak-families")
    kept = family.groupBy("family").agg(F.min(F.struct(F.col("id").alias("item_id"), "item_windows", "rich_windows")).alias("k")).select("family", "k.*")
    members = stage(family.select("id", "family").join(kept, "family").drop("family"), "leak-members")
    mine = raw.join(members, "id").filter(F.col("poor") | (F.col("id") == F.col("item_id")))
    slots = F.when(F.col("poor"), F.transform("slots", lambda _: F.lit(0).cast("long"))).otherwise(F.col("slots"))
    return mine.groupBy("item_id", F.col("pos").alias("ipos"), "item_windows", "rich_windows", "hash", "poor").agg(F.any_value(slots).alias("islots"))


def text_key():
    return F.xxhash64(F.coalesce("text", F.lit("")))


def find_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(text_key, item_id, n_windows, item_windows, verbatim) for every distinct text that leaks an item family.

    Texts are keyed by a hash of their content: copies are one, NULL is an empty text and leaks nothing, and
    doc_id may be NULL or repeated. Items with NULL id or text, or fewer than ``LEAST_TOKENS`` tokens, match
    nothing; of a repeated item_id one text counts. Other columns of both tables are ignored. Empty tables give
    an empty result.
    """
    with temporary(docs.sparkSession) as keep:
        items = stage(benchmark_windows(benchmark), "leak-bench")
        known = bit_filter(items, "hash")
        sizes = tuple(sorted(r[0] for r in items.select(F.size("islots")).distinct().collect())) or (WINDOW,)  # at most four numbers
        seen = docs.select(text_key().alias("key"), "text").mapInArrow(_window_tasks(known, sizes), _SCHEMA)
        # Copies of a text give equal rows, which meet and fall together before the join.
        seen = stage(seen.groupBy("id", "pos", "hash").agg(F.any_value("slots").alias("slots")), "leak-windows")
        pairs = seen.join(items, "hash").select(F.col("id").alias("text_key"), "item_id", "item_windows", "rich_windows", "ipos", "poor", (F.col("pos") - F.col("ipos")).alias("diagonal"),
                                                F.when(~F.col("poor"), F.arrays_zip(F.col("islots").alias("i"), F.col("slots").alias("d"))).alias("slots"))
        values = F.array_distinct(F.flatten(F.collect_list(F.filter("slots", lambda s: s["i"] != 0))))
        lines = pairs.groupBy("text_key", "item_id", "item_windows", "rich_windows", "diagonal").agg(
            F.size(F.collect_set("ipos")).cast("long").alias("n_windows"), F.size(F.collect_set(F.when(~F.col("poor"), F.col("ipos")))).alias("n_rich"), values.alias("v"))
        one_to_one = (F.size("v") == F.size(F.array_distinct(F.transform("v", lambda s: s["i"])))) & (F.size("v") == F.size(F.array_distinct(F.transform("v", lambda s: s["d"]))))
        enough = F.least(F.lit(RUN), "item_windows")
        template = (F.col("n_rich") > 0) & (F.col("n_rich") >= F.least(F.lit(RUN), "rich_windows")) | (F.col("n_windows") >= enough)
        good = lines.filter(one_to_one & template | (F.col("n_windows") - F.col("n_rich") >= enough))
        verbatim = F.forall("v", lambda s: s["i"] == s["d"])
        leaks = stage(good.groupBy("text_key", "item_id").agg(F.max("n_windows").alias("n_windows"), F.max("item_windows").alias("item_windows"),
                                                              F.max(verbatim).alias("verbatim")), "leaks")
        keep(leaks)
    return leaks


@query()
def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    leaks = find_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return docs.select("doc_id", text_key().alias("text_key")).join(leaks, "text_key").select(
        "doc_id", "item_id", "n_windows", "item_windows", "verbatim", F.lit(True).alias("leaked"))
