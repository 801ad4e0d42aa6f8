"""Cross-tokenizer alignment: divide and conquer at the byte offsets where tokens of two vocabularies both end.

A document becomes space+text. Its ends under vocabulary A and vocabulary B are two rising lists of byte offsets. An
interval of the document is cut at a common end near its middle, found by bisecting B's ends for the A end in the
middle, then for its neighbours further and further out; both halves go on alike. An interval without a common end inside
is a leaf, and leaves are the groups. All intervals of a block of documents that stand at the same depth are cut in
one numpy step. Links are the A-B pairs of a group; ids that are linked in many documents belong together.

Neither vocabulary joins across a space that follows a visible character, so words are encoded once per block and
remembered by the task; ids of a document are the ids of its words in a row. Alignment itself runs over whole documents.

Texts are encoded once: counts, digests and each document's distinct id pairs are staged. Spark counts the pairs over all
documents. Pairs that occur often travel to the tasks (``TRAVEL`` of them at most, and one number per A id); all
others, if there are any, come from a join.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom.llm.registry import query
from docloom.llm.wordhash import text_blocks
from docloom.staging import stage

TOKENIZERS = "/opt/tokenizers"
FILE_A, FILE_B = "byte_bpe_50k.json", "piece_bpe_32k.model"
REMEMBERED, RUN = 96 << 20, 4000  # bytes of words a task remembers, words encoded as one text
SMALL_GROUP = 256  # pairs of a group that are written out before equal ones are added up
TRAVEL = 1 << 20


class Vocabularies:
    """Both tokenizers, the bytes of their entries, and the words a task has met."""

    def __init__(self, folder: str, file_a: str = FILE_A, file_b: str = FILE_B):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(os.path.join(folder, file_a))
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=os.path.join(folder, file_b))
        self.bytes_a, self.bytes_b = _bytes_of_a(self.a), _bytes_of_b(self.b)
        self.length_a, self.length_b = (np.array([len(x) for x in y], dtype=np.int64) for y in (self.bytes_a, self.bytes_b))
        self.forget()

    def forget(self) -> None:
        self.known, self.size = {}, 0
        # Ids of all remembered words in a row, and where each word's begin and how many there are.
        self.ids = [np.zeros(0, dtype=np.int32)] * 2
        self.first = [np.zeros(0, dtype=np.int64)] * 2
        self.count = [np.zeros(0, dtype=np.int64)] * 2

    def learn(self, words: list[bytes]) -> np.ndarray:
        """The number of every word among the remembered ones; -1 for those one vocabulary does not give back."""
        if self.size > REMEMBERED:
            self.forget()
        new = [w for w in words if w not in self.known]
        joined = [w for w in new if _ends_visible(w)]
        found = [[], []]
        for a in range(0, len(joined), RUN):
            self._encode(joined[a:a + RUN], found)
        for word in new:
            if not _ends_visible(word):
                self._encode([word], found)
        for side, parts in enumerate(found):
            if parts:
                counts = np.concatenate([c for _, c in parts])
                self.first[side] = np.concatenate([self.first[side], len(self.ids[side]) + np.cumsum(counts) - counts])
                self.count[side] = np.concatenate([self.count[side], counts])
                self.ids[side] = np.concatenate([self.ids[side], *(i for i, _ in parts)])
        self.size += sum(map(len, new)) + 200 * len(new)
        return np.array([self.known[w] for w in words], dtype=np.int64)

    def _encode(self, words: list[bytes], found: list[list]) -> None:
        """Encode words as one text; where that does not give their bytes back, half by half down to the word at fault."""
        whole = b"".join(words)
        try:
            text = whole.decode()
            ids_a = self.a.encode(text, add_special_tokens=False).ids
            # B puts a space before its text; a text that is one space is its space piece alone.
            ids_b = self.b.encode(text[1:], num_threads=1) if len(text) > 1 else [self.b.piece_to_id("▁")]
            same = b"".join([self.bytes_a[i] for i in ids_a]) == whole == b"".join([self.bytes_b[i] for i in ids_b])
        except UnicodeDecodeError:
            same = False
        if not same:
            if len(words) == 1:
                self.known[words[0]] = -1
            else:
                self._encode(words[:len(words) // 2], found)
                self._encode(words[len(words) // 2:], found)
            return
        ends = np.cumsum([len(w) for w in words])
        for side, ids, lengths in ((0, ids_a, self.length_a), (1, ids_b, self.length_b)):
            ids = np.array(ids, dtype=np.int32)
            last = np.searchsorted(np.cumsum(lengths[ids]), ends)
            found[side].append((ids, np.diff(last, prepend=-1)))
        number = len(self.first[0]) + sum(len(c) for _, c in found[0]) - len(words)
        self.known.update(zip(words, range(number, number + len(words)), strict=True))

    def tokens(self, side: int, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the numbered words in a row, and how many each word has."""
        counts = self.count[side][numbers]
        total = np.cumsum(counts)
        at = np.arange(total[-1] if len(total) else 0) + np.repeat(self.first[side][numbers] - total + counts, counts)
        return self.ids[side][at], counts


def _ends_visible(word: bytes) -> bool:
    last = word[-1]
    return 32 < last < 127 or 0x80 <= last < 0xC0 and len(word) > 1 and 0xC3 <= word[-2] <= 0xDF


def _bytes_of_a(tokenizer) -> list[bytes]:
    """Entries of a byte-level vocabulary as bytes. Printable bytes stand for themselves, the others in order for U+0100 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(sorted(set(range(256)) - set(plain)))}
    out = [b""] * tokenizer.get_vocab_size(with_added_tokens=True)
    added = {i: t.content.encode() for i, t in tokenizer.get_added_tokens_decoder().items()}
    for entry, i in tokenizer.get_vocab(with_added_tokens=True).items():
        out[i] = added[i] if i in added else bytes(letters[c] for c in entry)
    return out


def _bytes_of_b(processor) -> list[bytes]:
    """Pieces in UTF-8 with U+2581 as a space; byte pieces as their byte; control and unknown pieces as nothing."""
    out = []
    for i in range(processor.get_piece_size()):
        piece = processor.id_to_piece(i)
        if processor.is_byte(i):
            out.append(bytes([int(piece[3:-1], 16)]))
        else:
            out.append(b"" if processor.is_control(i) or processor.is_unknown(i) else piece.replace("▁", " ").encode())
    return out


def cut_words(data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Where words begin: at every text start and at every space right after a visible character of one or two bytes."""
    space = data == 32
    visible = (data > 32) & (data < 127)
    # The second byte of a two-byte character; those led by 0xC2 hold white space and stay whole.
    visible[1:] |= (data[1:] >= 0x80) & (data[1:] < 0xC0) & (data[:-1] >= 0xC3) & (data[:-1] <= 0xDF)
    begins = np.zeros(len(data), dtype=bool)
    begins[1:] = space[1:] & visible[:-1]
    begins[starts] = True
    return np.flatnonzero(begins)


def shared_cuts(ends_a: np.ndarray, ends_b: np.ndarray, last_a: np.ndarray, last_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Booleans per A token and B token: its end is a cut.

    ``ends_a`` and ``ends_b`` rise over a whole block of texts; ``last_a`` and ``last_b`` are the numbers of each
    text's last tokens, whose ends are equal. Every pass of the loop cuts all open intervals of one depth.
    """
    cut_a, cut_b = np.zeros(len(ends_a), dtype=bool), np.zeros(len(ends_b), dtype=bool)
    cut_a[last_a] = cut_b[last_b] = True
    # An interval is (first A token, last A token, first B token, last B token).
    low_a, high_a = np.concatenate([[0], last_a[:-1] + 1]), last_a
    low_b, high_b = np.concatenate([[0], last_b[:-1] + 1]), last_b
    while len(low_a):
        open_ = (low_a < high_a) & (low_b < high_b)
        low_a, high_a, low_b, high_b = low_a[open_], high_a[open_], low_b[open_], high_b[open_]
        middle = (low_a + high_a - 1) // 2
        found_a, found_b = np.full(len(low_a), -1), np.full(len(low_a), -1)
        looking, near, reach = np.arange(len(low_a)), 0, 1
        while len(looking):
            # Ends at a distance of near .. reach - 1 from the middle, on both sides, for every interval still looking.
            steps = np.arange(near, reach)
            steps = np.concatenate([steps, -steps[steps > 0]])
            at = middle[looking][:, None] + steps
            inside = (at >= low_a[looking][:, None]) & (at < high_a[looking][:, None])
            row, column = np.nonzero(inside)
            tried = at[row, column]
            place = np.searchsorted(ends_b, ends_a[tried])
            hit = ends_b[np.minimum(place, len(ends_b) - 1)] == ends_a[tried]
            # The nearest hit of each interval.
            order = np.lexsort((np.abs(steps[column[hit]]), row[hit]))
            rows, first = np.unique(row[hit][order], return_index=True)
            found_a[looking[rows]], found_b[looking[rows]] = tried[hit][order][first], place[hit][order][first]
            left = np.ones(len(looking), dtype=bool)
            left[rows] = False
            left &= (middle[looking] + reach < high_a[looking]) | (middle[looking] - reach >= low_a[looking])
            looking, near, reach = looking[left], reach, 2 * reach
        cut = found_a >= 0
        low_a, high_a, low_b, high_b, found_a, found_b = (x[cut] for x in (low_a, high_a, low_b, high_b, found_a, found_b))
        cut_a[found_a] = cut_b[found_b] = True
        low_a, high_a = np.concatenate([low_a, found_a + 1]), np.concatenate([found_a, high_a])
        low_b, high_b = np.concatenate([low_b, found_b + 1]), np.concatenate([found_b, high_b])
    return cut_a, cut_b


def _written(ids_a, ids_b, group_a, group_b, count_a, count_b, closes: np.ndarray, digits: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """``a1,a2|b1;a3|b2`` of all groups in a row as bytes, and where each group ends; ``closes``: a text's last group."""
    before_a, before_b = np.cumsum(count_a) - count_a, np.cumsum(count_b) - count_b
    total = len(ids_a) + len(ids_b)
    slot_a = np.arange(len(ids_a)) + before_b[group_a]
    slot_b = np.arange(len(ids_b)) + (before_a + count_a)[group_b]
    ids, mark = np.empty(total, dtype=np.int64), np.full(total, ord(","), dtype=np.uint8)
    ids[slot_a], ids[slot_b] = ids_a, ids_b
    end_a, end_b = before_a + before_b + count_a, before_a + before_b + count_a + count_b
    mark[end_a - 1] = ord("|")
    mark[end_b - 1] = np.where(closes, 0, ord(";"))
    table, lengths = digits
    rows, size = table[ids], lengths[ids]
    rows[np.arange(total), size] = mark
    keep = np.arange(table.shape[1]) < (size + (mark > 0))[:, None]
    return rows[keep], np.cumsum(size + (mark > 0))[end_b - 1]


def _digits(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Decimal digits of 0..size-1, one row each with room for a mark behind, and their number."""
    width = len(str(size)) + 1
    text = np.array([str(i).ljust(width) for i in range(size)], dtype=f"S{width}")
    return text.view(np.uint8).reshape(size, width), np.array([len(str(i)) for i in range(size)], dtype=np.int64)


def _pairs(ids_a, ids_b, group_a, count_a, count_b, text_of_group, width: int, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (text, A id, B id) of all links as sorted numbers text << bits | a * width + b, and how often each is linked."""
    first_a, first_b = np.cumsum(count_a) - count_a, np.cumsum(count_b) - count_b
    large = count_a * count_b > SMALL_GROUP
    of_a = ~large[group_a]
    times = np.where(of_a, count_b[group_a], 0)
    group = np.repeat(group_a, times)
    ends = np.cumsum(times)
    b_at = first_b[group] + np.arange(len(group)) - np.repeat(ends - times, times)
    keys = (text_of_group[group] << bits) + np.repeat(ids_a.astype(np.int64), times) * width + ids_b[b_at]
    keys.sort()
    heads = np.flatnonzero(np.diff(keys, prepend=-1))
    keys, weights = keys[heads], np.diff(np.append(heads, len(keys)))
    more = []
    for g in np.flatnonzero(large).tolist():
        a, times_a = np.unique(ids_a[first_a[g]:first_a[g] + count_a[g]].astype(np.int64), return_counts=True)
        b, times_b = np.unique(ids_b[first_b[g]:first_b[g] + count_b[g]], return_counts=True)
        more.append((((text_of_group[g] << bits) + a[:, None] * width + b).ravel(), np.outer(times_a, times_b).ravel()))
    if more:
        keys, weights = (np.concatenate([x, *y]) for x, y in zip((keys, weights), zip(*more, strict=True), strict=True))
        order = np.argsort(keys, kind="stable")
        keys = keys[order]
        heads = np.flatnonzero(np.diff(keys, prepend=-1))
        keys, weights = keys[heads], np.add.reduceat(weights[order], heads)
    return keys, weights


def align_block(data: np.ndarray, offsets: np.ndarray, words: Vocabularies, digits: tuple) -> dict[str, np.ndarray | list]:
    """Counts, digest and distinct linked id pairs of every text of a block."""
    n = len(offsets) - 1
    out = {k: np.zeros(n, dtype=np.int64) for k in ("n_a", "n_b", "n_groups", "n_links", "pairs")} | {"sha": [""] * n}
    width, bits = len(words.bytes_b), max(1, (len(words.bytes_a) * len(words.bytes_b)).bit_length())
    texts = np.flatnonzero(np.diff(offsets))
    none = np.zeros(0, dtype=np.int64)
    if not len(texts):
        return out | {"keys": none, "links": none}
    data = np.insert(data, offsets[texts], 32)
    starts = offsets[texts] + np.arange(len(texts))
    begins = cut_words(data, starts)
    coded = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(begins), [None, pa.py_buffer(np.append(begins, len(data)).astype(np.int64)), pa.py_buffer(data)]).dictionary_encode()
    number = words.learn(coded.dictionary.to_pylist())[coded.indices.to_numpy()]
    text_of = np.searchsorted(starts, begins, side="right") - 1
    whole = np.bincount(text_of, weights=number < 0, minlength=len(texts)) == 0
    number, text_of = number[whole[text_of]], text_of[whole[text_of]]
    if not len(number):
        return out | {"keys": none, "links": none}
    ids_a, tokens_a = words.tokens(0, number)
    ids_b, tokens_b = words.tokens(1, number)
    held = np.flatnonzero(whole)
    n_a, n_b = (np.bincount(text_of, weights=t, minlength=len(texts)).astype(np.int64)[held] for t in (tokens_a, tokens_b))
    cut_a, cut_b = shared_cuts(np.cumsum(words.length_a[ids_a]), np.cumsum(words.length_b[ids_b]), np.cumsum(n_a) - 1, np.cumsum(n_b) - 1)
    group_a, group_b = np.cumsum(cut_a) - cut_a, np.cumsum(cut_b) - cut_b
    count_a, count_b = np.bincount(group_a), np.bincount(group_b)
    last = group_a[np.cumsum(n_a) - 1]
    closes = np.zeros(len(count_a), dtype=bool)
    closes[last] = True
    text_of_group = texts[held][np.cumsum(closes) - closes]
    written, end = _written(ids_a, ids_b, group_a, group_b, count_a, count_b, closes, digits)
    written, end = memoryview(written), end[last].tolist()
    keys, links = _pairs(ids_a, ids_b, group_a, count_a, count_b, text_of_group, width, bits)
    rows = texts[held]
    out["n_a"][rows], out["n_b"][rows], out["n_groups"][rows] = n_a, n_b, np.diff(last, prepend=-1)
    np.add.at(out["n_links"], text_of_group, count_a * count_b)
    for row, a, b in zip(rows.tolist(), [0, *end], end, strict=False):
        out["sha"][row] = hashlib.sha256(written[a:b]).hexdigest()
    out["pairs"] = np.bincount(keys >> bits, minlength=n)
    return out | {"keys": keys & ((1 << bits) - 1), "links": links}


def _align_tasks(folder: str):
    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Vocabularies(folder)
        digits = _digits(max(len(words.bytes_a), len(words.bytes_b)))
        number = TaskContext.get().partitionId() << 40
        for batch in batches:
            for row, data, offsets in text_blocks(batch.column(1)):
                found = align_block(data, offsets, words, digits)
                size = len(offsets) - 1
                ends = pa.array(np.concatenate([[0], np.cumsum(found["pairs"])]), pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.arange(number, number + size)), batch.column(0).slice(row, size),
                     *(pa.array(found[k]) for k in ("n_a", "n_b", "n_groups", "n_links")), pa.array(found["sha"]),
                     pa.ListArray.from_arrays(ends, pa.array(found["keys"])), pa.ListArray.from_arrays(ends, pa.array(found["links"], pa.int64()))],
                    ["row", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "keys", "links"])
                number += size

    return align


def _count_tasks(width: int, keys: np.ndarray, counts: np.ndarray, best: np.ndarray):
    """Adds up the counts of the pairs in ``keys`` (sorted); ``best``: highest count per A id. Other pairs are passed on."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists, times = batch.column("keys"), batch.column("links").flatten().to_numpy()
            key = lists.flatten().to_numpy()
            row = np.repeat(np.arange(len(lists)), lists.value_lengths().to_numpy())
            place = np.minimum(np.searchsorted(keys, key), max(0, len(keys) - 1))
            known = keys[place] == key if len(keys) else np.zeros(len(key), dtype=bool)
            count_of = np.where(known, counts[place], 0) if len(keys) else np.zeros(len(key), dtype=np.int64)
            sums, tops = np.zeros(len(lists), dtype=np.int64), np.zeros(len(lists), dtype=np.int64)
            np.add.at(sums, row, count_of * times)
            top = known & (count_of == best[key // width])
            np.add.at(tops, row[top], times[top])
            ends = pa.array(np.concatenate([[0], np.cumsum(np.bincount(row[~known], minlength=len(lists)))]), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("row", "doc_id", "n_a", "n_b", "n_groups", "n_links")), pa.array(tops), pa.array(sums), batch.column("groups_sha256"),
                 pa.ListArray.from_arrays(ends, pa.array(key[~known])), pa.ListArray.from_arrays(ends, pa.array(times[~known]))],
                ["row", "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256", "keys", "links"])

    return count


COLUMNS = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


def align(docs: DataFrame, folder: str = TOKENIZERS, travel: int = TRAVEL) -> tuple[DataFrame, DataFrame]:
    """(one row per document, one row per linked id pair) of ``docs`` (doc_id, text).

    Documents: ``COLUMNS``. Pairs: a, b, documents (how many rows of ``docs`` hold the pair linked). NULL, empty and
    wordless texts, texts that are no UTF-8, and texts that one vocabulary does not give back byte for byte have no
    tokens: zeros and an empty digest. Repeated rows count as often as they come; NULL ids are kept; other columns of
    ``docs`` are ignored. An empty table gives two empty ones. A task holds one block of texts (a few MB, or one
    longer text) and its distinct pairs. The folder must hold the vocabulary files on every executor.
    """
    kinds = "row long, doc_id long, n_a long, n_b long, n_groups long, n_links long"
    sizes = Vocabularies(folder)
    width, most = len(sizes.bytes_b), len(sizes.bytes_a)
    # Distinct pairs are staged, not texts or tokens: a few bytes per word.
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    aligned = stage(docs.mapInArrow(_align_tasks(folder), f"{kinds}, groups_sha256 string, keys array<long>, links array<long>"), "align-texts")
    pairs = stage(aligned.select(F.explode("keys").alias("key")).groupBy("key").agg(F.count("*").alias("documents")), "align-pairs")
    # The level above which at most ``travel`` pairs lie, from a table of one row per eighth of a power of two.
    level = F.floor(F.log2("documents") * 8).cast("int")
    levels = pairs.groupBy(level.alias("level")).count().orderBy(F.desc("level")).collect()
    least, rest = None, 0
    for r in levels:
        rest += r["count"]
        if rest <= travel:
            least = r["level"]
    frequent = pairs.filter(level >= least) if least is not None else pairs.limit(0)
    table = frequent.toArrow().sort_by("key")
    keys, counts = table["key"].to_numpy(), table["documents"].to_numpy()
    top = pairs.groupBy(F.expr(f"key div {width}").alias("a")).agg(F.max("documents").alias("best"))
    best = np.zeros(most, dtype=np.int64)
    of_id = top.toArrow()  # at most one row per id of A
    best[of_id["a"].to_numpy()] = of_id["best"].to_numpy()
    counted = aligned.mapInArrow(_count_tasks(width, keys, counts, best),
                                 f"{kinds}, n_best long, count_sum long, groups_sha256 string, keys array<long>, links array<long>")
    if rest > travel:
        counted = stage(counted, "align-counted")
        left = counted.select("row", F.explode(F.arrays_zip("keys", "links")).alias("pair")).select("row", "pair.keys", "pair.links")
        joined = left.join(pairs.select(F.col("key").alias("keys"), "documents"), "keys").withColumn("a", F.expr(f"keys div {width}")).join(top, "a")
        more = joined.groupBy("row").agg(F.sum(F.col("links") * F.col("documents")).alias("more_sum"),
                                         F.sum(F.when(F.col("documents") == F.col("best"), F.col("links")).otherwise(0)).alias("more_best"))
        counted = (counted.join(stage(more, "align-rare"), "row", "left")
                   .withColumn("n_best", F.col("n_best") + F.coalesce("more_best", F.lit(0)))
                   .withColumn("count_sum", F.col("count_sum") + F.coalesce("more_sum", F.lit(0))))
    documents = counted.select(*(c.split()[0] for c in COLUMNS.split(", ")))
    return documents, pairs.select(F.expr(f"key div {width}").alias("a"), (F.col("key") % width).alias("b"), "documents")


@query()
def op13_cross_tokenizer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align(spark.read.parquet(f"{sf_dir}/documents.parquet"))[0]
