"""Document toxicity: a bidirectional GRU with attention pooling over words and their characters.

Words are runs of letters, digits and non-ASCII bytes. A word's input is the mean of its character-trigram
vectors plus, when it occurs in enough training documents, a vector of its own. All overlapping windows of
``WINDOW`` words, one from every word on, of the whole text are scored, whatever its length, and the
highest window decides. Only fitting takes windows ``STRIDE`` words apart; its cut is placed by all windows.

The network is fitted in numpy on the driver, on a sample with a fixed bound: at most ``PER_CLASS`` labelled
documents of each class, taken by hash order, of at most ``TRAIN_CHARS`` characters each. Scoring runs over
every document inside Spark tasks; the fitted network is under 1 MB.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom.llm import gru
from docloom.llm.registry import query
from docloom.llm.wordhash import _LOWER, mix, span_hashes, text_blocks, word_bounds

WINDOW, STRIDE = 32, 24
DIM, HIDDEN, WORDS, GRAMS = 16, 8, 8192, 4096
PER_CLASS, TRAIN_CHARS, MIN_DOCS = 800, 10_000, 4
EPOCH_WINDOWS, STEPS = 10_000, 40  # windows of a class at most, gradient steps at least, per round
THRESHOLD, BATCH_WINDOWS = 0.7, 2048
SEED = 11

_BETWEEN = np.ones(256, dtype=bool)
_BETWEEN[48:58] = _BETWEEN[65:91] = _BETWEEN[97:123] = _BETWEEN[128:] = False


def _grams(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Trigram ids of the given words (with edge marks), concatenated, and where each word's begin."""
    lengths = ends - starts
    first = np.concatenate([[0], np.cumsum(lengths)])
    within = np.arange(first[-1]) - np.repeat(first[:-1], lengths)
    at = np.repeat(starts, lengths) + within
    folded = _LOWER[data].astype(np.uint64)
    left = np.where(within == 0, np.uint64(1), folded[np.maximum(at - 1, 0)])
    right = np.where(within == np.repeat(lengths, lengths) - 1, np.uint64(2), folded[np.minimum(at + 1, len(data) - 1)])
    ids = mix((left << np.uint64(16)) + (folded[at] << np.uint64(8)) + right) & np.uint64(GRAMS - 1)
    return ids.astype(np.int64), first


def _windows(first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For fitting: word index per step and window (step, window), -1 for padding, and the document of each window."""
    lengths = np.diff(first)
    counts = np.where(lengths > 0, 1 + np.maximum(0, -(-(lengths - WINDOW) // STRIDE)), 0)
    owner = np.repeat(np.arange(len(lengths)), counts)
    rank = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
    ids = (first[owner] + rank * STRIDE)[None, :] + np.arange(WINDOW)[:, None]
    return np.where(ids < first[owner + 1][None, :], ids, -1), owner


def _distinct_words(data: np.ndarray, offsets: np.ndarray, vocabulary: np.ndarray | None):
    starts, ends, first = word_bounds(data, offsets, _BETWEEN)
    hashes = span_hashes(data, starts, ends)
    distinct, at, inverse = np.unique(hashes, return_index=True, return_inverse=True)
    ids = np.zeros(len(distinct), dtype=np.int64)
    if vocabulary is not None and len(vocabulary) and len(distinct):
        place = np.minimum(np.searchsorted(vocabulary, distinct), len(vocabulary) - 1)
        ids = np.where(vocabulary[place] == distinct, place + 1, 0)
    gram_ids, gram_first = _grams(data, starts[at], ends[at])
    return (ids, gram_ids, gram_first), inverse, first, distinct


def score_texts(texts: pa.Array, model: dict) -> np.ndarray:
    """Highest window logit of each text, with a window from every word on; -inf for texts without a word."""
    out = np.full(len(texts), -np.inf)
    for row, data, offsets in text_blocks(texts):
        words, inverse, first, _ = _distinct_words(data, offsets, model["vocabulary"])
        lengths = np.diff(first)
        if not lengths.any():
            continue
        rows = np.ascontiguousarray(gru.gate_inputs(*words, model["net"]).T)
        # Short texts are padded to one window. The windows of long ones are runs of neighbours in one list of words.
        padded = np.where(lengths > 0, np.maximum(lengths, WINDOW), 0)
        begin = np.cumsum(padded) - padded
        list_of = np.full(padded.sum(), len(rows) - 1)
        owner = np.repeat(np.arange(len(lengths)), lengths)
        list_of[begin[owner] + np.arange(len(owner)) - first[owner]] = inverse
        n, real = np.minimum(lengths, WINDOW), np.repeat(lengths >= WINDOW, padded)
        best = np.empty(len(list_of) - WINDOW + 1, np.float32)
        for a in range(0, len(best), BATCH_WINDOWS):
            b = min(a + BATCH_WINDOWS, len(best))
            x = np.ascontiguousarray(rows[list_of[a:b + WINDOW - 1]].T)
            mask = None if real[a:b].all() else list_of[np.arange(a, b) + np.arange(WINDOW)[:, None]] < len(rows) - 1
            best[a:b] = gru.sliding_logits(x, WINDOW, mask, model["net"])
        for k in np.flatnonzero(n):
            out[row + k] = best[begin[k]:begin[k] + padded[k] - WINDOW + 1].max()
    return out


def train(texts: list[str], labels: np.ndarray, seed: int = SEED, rounds: tuple[int, int] = (2, 4)) -> dict | None:
    """Fit on whole texts; None unless both classes are there.

    First rounds: every window carries its document's label. Later rounds: only the highest windows do
    (one of a toxic document, two of a clean one), and known words are hidden at random, so that characters
    must carry the meaning of words never seen.
    """
    labels = np.asarray(labels, dtype=np.float32)
    if len(set(labels.tolist())) < 2:
        return None
    rng = np.random.default_rng(seed)
    data = np.frombuffer("\n".join(texts).encode(), dtype=np.uint8)
    lengths = np.array([len(t.encode()) + 1 for t in texts])
    offsets = np.concatenate([[0], np.cumsum(lengths)])
    offsets[-1] = len(data)
    (_, gram_ids, gram_first), inverse, first, distinct = _distinct_words(data, offsets, None)
    doc_of = np.repeat(np.arange(len(texts)), np.diff(first))
    in_docs = np.bincount(np.unique(np.stack([inverse, doc_of]), axis=1)[0], minlength=len(distinct))
    common = np.flatnonzero(in_docs >= MIN_DOCS)
    common = np.sort(common[np.argsort(-in_docs[common], kind="stable")[:WORDS]])
    word_ids = np.zeros(len(distinct), dtype=np.int64)
    word_ids[common] = np.arange(1, len(common) + 1)
    net = gru.init(DIM, HIDDEN, len(common), GRAMS, seed)
    ids, owner = _windows(first)
    lookup = np.append(inverse, -1)
    ids = lookup[ids]
    adam = gru.Adam(net, 0.01)

    def epoch(chosen: np.ndarray, hidden_words: float = 0.3) -> None:
        size = int(np.clip(len(chosen) // STEPS, 32, 256))
        chosen = np.concatenate([rng.permutation(chosen) for _ in range(max(1, -(-STEPS * size // len(chosen))))])
        for a in range(0, len(chosen), size):
            part = ids[:, chosen[a:a + size]]
            used, local = np.unique(part, return_inverse=True)
            local = local.reshape(part.shape)
            if used[0] == -1:
                used, local = used[1:], local - 1
            first_of = gram_first[used]
            n = gram_first[used + 1] - first_of
            starts = np.concatenate([[0], np.cumsum(n)])
            grams = gram_ids[np.repeat(first_of - starts[:-1], n) + np.arange(starts[-1])]
            known = np.where(rng.random(len(used)) < hidden_words, 0, word_ids[used])
            _, g = gru.gradients(local, labels[owner[chosen[a:a + size]]], (known, grams, starts), net)
            adam.step(net, g)

    def all_logits() -> np.ndarray:
        rows = np.ascontiguousarray(gru.gate_inputs(word_ids, gram_ids, gram_first, net).T)
        return np.concatenate([gru.logits(np.ascontiguousarray(np.take(rows, ids[:, a:a + BATCH_WINDOWS], axis=0).transpose(0, 2, 1)),
                                          ids[:, a:a + BATCH_WINDOWS] >= 0, net) for a in range(0, ids.shape[1], BATCH_WINDOWS)])

    # Every fourth document only serves to place the cut.
    learnt = np.arange(len(texts)) % 4 > 0
    positive, negative = (np.flatnonzero((labels[owner] == c) & learnt[owner]) for c in (1, 0))
    if not len(positive) or not len(negative):
        return None
    for _ in range(rounds[0]):
        take = min(len(positive), len(negative), EPOCH_WINDOWS)
        epoch(np.concatenate([rng.choice(positive, take, replace=False), rng.choice(negative, take, replace=False)]))
    for k in range(rounds[1]):
        adam.rate = 0.01 if k < rounds[1] - 2 else 0.003
        z = all_logits()
        order = np.lexsort((-z, owner))
        rank = np.arange(len(order)) - np.searchsorted(owner[order], owner[order])
        top = order[learnt[owner[order]] & ((rank == 0) | (rank < 3) & (labels[owner[order]] == 0))]
        epoch(np.concatenate([top, rng.choice(negative, min(len(negative), len(top)), replace=False)]))
    heads = np.flatnonzero(np.diff(owner, prepend=-1))
    label = labels[owner[heads]]
    unseen = ~learnt[owner[heads]]
    if label[unseen].sum() < 20 or (label[unseen] == 0).sum() < 20:
        unseen[:] = True
    fitted = {"net": net, "vocabulary": distinct[common]}
    best, label = score_texts(pa.array([texts[i] for i in owner[heads][unseen]]), fitted), label[unseen]
    cuts = np.sort(best)
    cuts = (cuts[:-1] + cuts[1:]) / 2 if len(cuts) > 1 else cuts
    hits = np.array([(label[best >= c] > 0).sum() for c in cuts])
    f1 = 2 * hits / (np.array([(best >= c).sum() for c in cuts]) + (label > 0).sum())
    good = cuts[f1 >= f1.max() - 1e-12]
    return fitted | {"cut": float((good.min() + good.max()) / 2)}


def to_score(logit: np.ndarray, cut: float) -> np.ndarray:
    """Logits to (0, 1), with the cut at the decision threshold; no words score 0."""
    shift = np.log(THRESHOLD / (1 - THRESHOLD))
    with np.errstate(over="ignore"):
        return 1 / (1 + np.exp(-(logit - cut + shift)))


def training_fold() -> object:
    """True for ids that may be learnt from."""
    return F.crc32(F.col("doc_id").cast("string")) % 3 != 1


def fit(docs: DataFrame, labels: DataFrame) -> dict | None:
    """The network from labelled rows outside the held-out fold, or None when a class is missing."""
    allowed = labels.select("doc_id", "toxic").filter(training_fold() & F.col("toxic").isin(0, 1))
    allowed = allowed.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    short = docs.select("doc_id", "text").filter(F.length("text").between(1, TRAIN_CHARS))
    picked = [allowed.filter(F.col("toxic") == c).orderBy(F.xxhash64("doc_id"), "doc_id").limit(PER_CLASS) for c in (0, 1)]
    ids = picked[0].union(picked[1])  # at most 2 * PER_CLASS rows
    sample = short.join(F.broadcast(ids), "doc_id").groupBy("doc_id").agg(F.min("text").alias("text"), F.first("toxic").alias("toxic"))
    rows = sample.toArrow().sort_by("doc_id")
    return train(rows["text"].to_pylist(), rows["toxic"].to_numpy())


def score_documents(docs: DataFrame, model: dict | None, text: str = "text", score: str = "toxicity") -> DataFrame:
    """``docs`` with a column ``score`` (double in 0..1) for every row, in place and without a shuffle.

    NULL, empty and wordless texts score 0.0, as does everything when there is no model. Other columns and
    repeats are kept; a column that already has the name is replaced.
    """
    def score_batches(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for part in texts:
            values = np.zeros(len(part)) if model is None else to_score(score_texts(part, model), model["cut"])
            yield pa.array(values, pa.float64())

    return docs.withColumn(score, F.arrow_udf(score_batches, "double")(F.col(text)))


@query()
def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    model = fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return score_documents(docs, model).select(
        "doc_id", F.coalesce(~training_fold(), F.lit(False)).alias("held_out"), F.col("toxicity").alias("score"),
        (F.col("toxicity") >= THRESHOLD).cast("int").alias("predicted"))
