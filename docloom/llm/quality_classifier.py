"""Document quality: random-indexing word vectors pooled per document, then a calibrated two-layer network.

Every word has a sparse random index vector, drawn from the hash of its letters and from the hash of its shape
(``Xx.``, ``x###``). One pass over all documents adds to the context vector of a word, and to that of its shape, the index
vectors of the words up to ``REACH`` places before and behind it. Context vectors live in tables of a fixed number of
rows, chosen by hash, so every word of the corpus has its part and nothing grows with the vocabulary; Spark adds up
the tasks' tables.

A document is pooled over its whole text: mean and spread of its words' vectors, mean product of neighbouring
vectors, mean index vector, and how often index vectors come back at the next places. A network with one hidden
layer is fitted in numpy on the pooled vectors of at most ``LABELLED`` labelled documents, taken by hash order; a fifth
of them only sets the temperature that makes its probabilities honest.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom.llm.registry import query
from docloom.llm.wordhash import span_hashes, text_blocks, word_bounds

DIM, REACH, LAGS = 32, 2, 3
WORD_ROWS, SHAPE_ROWS = 1 << 13, 1 << 9
PIECE = 1 << 12  # words worked on at once: their columns (2 MB) stay in the cache of a core
LABELLED, HIDDEN, ROUNDS, RATE, DECAY = 8_000, 24, 40, 0.004, 1e-4
THRESHOLD = 0.3
SEED = 7

_AS_IS = np.arange(256, dtype=np.uint8)
# Classes of bytes for shapes: small and non-ASCII letters, capitals, digits; other bytes stand for themselves.
_CLASS = np.arange(256, dtype=np.uint8)
_CLASS[97:123] = _CLASS[128:] = ord("x")
_CLASS[65:91] = ord("X")
_CLASS[48:58] = ord("0")
FEATURES = 4 * DIM + LAGS


def _index_vectors(hashes: np.ndarray) -> np.ndarray:
    """Sparse random vectors: four entries of +1 or -1, placed by the hash."""
    out = np.zeros((len(hashes), DIM), dtype=np.float32)
    at = np.arange(len(hashes))
    for k in range(4):
        place = (hashes >> np.uint64(8 * k)).astype(np.int64) % DIM
        out[at, place] += 1 - 2 * ((hashes >> np.uint64(40 + k)) & np.uint64(1)).astype(np.float32)
    return out


class _Piece:
    """Up to ``PIECE`` neighbouring words of a block: their distinct (word, shape) kinds and the text of each word."""

    def __init__(self, words: np.ndarray, shapes: np.ndarray, text_of: np.ndarray):
        _, at, self.kind = np.unique(words, return_index=True, return_inverse=True)
        self.text_of = text_of
        self.rows = (words[at] >> np.uint64(50)).astype(np.int64) % WORD_ROWS, WORD_ROWS + (shapes[at] >> np.uint64(50)).astype(np.int64) % SHAPE_ROWS
        self.index = _index_vectors(words[at]) + _index_vectors(shapes[at])

    def together(self, lag: int) -> np.ndarray:
        """True for words whose text also holds the word ``lag`` places on, inside the piece."""
        return self.text_of[lag:] == self.text_of[:-lag]


def _pieces(texts: pa.Array) -> Iterator[tuple[int, int, _Piece]]:
    """(first row of the block, words carried over from the piece before, piece). A text may span many pieces.

    Pieces of a block overlap by ``LAGS`` words, so that no pair of near words is missed; the carried words come first.
    """
    for row, data, offsets in text_blocks(texts):
        starts, ends, first = word_bounds(data, offsets)
        if not len(starts):
            continue
        words = span_hashes(data, starts, ends, _AS_IS)
        # Shapes: equal neighbours of a word count once.
        kind = _CLASS[data]
        fresh = np.ones(len(data), dtype=bool)
        fresh[1:] = kind[1:] != kind[:-1]
        fresh[starts] = True
        at = np.concatenate([[0], np.cumsum(fresh)])
        shapes = span_hashes(kind[fresh], at[starts], at[ends], _AS_IS)
        text_of = np.repeat(np.arange(len(offsets) - 1), np.diff(first))
        for a in range(0, len(words), PIECE):
            b, carried = a + PIECE, min(a, LAGS)
            yield row, carried, _Piece(words[a - carried:b], shapes[a - carried:b], text_of[a - carried:b])


def _context_tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Context sums of a task: one row per used table row, DIM sums and the number of neighbours added."""
    table = np.zeros((WORD_ROWS + SHAPE_ROWS, DIM + 1), dtype=np.int64)
    for batch in batches:
        for _, carried, piece in _pieces(batch.column(0)):
            index = piece.index[piece.kind]
            index = np.concatenate([index, np.ones((len(index), 1), dtype=np.float32)], axis=1)
            around = np.zeros_like(index)
            for lag in range(1, REACH + 1):
                if len(index) <= lag:
                    break
                here = piece.together(lag)
                here[:max(0, carried - lag)] = False  # both words were in the piece before
                around[:-lag][here] += index[lag:][here]
                around[lag:][here] += index[:-lag][here]
            order = np.argsort(piece.kind, kind="stable")
            sums = np.add.reduceat(around[order], np.flatnonzero(np.diff(piece.kind[order], prepend=-1)), axis=0)
            for rows in piece.rows:
                order = np.argsort(rows, kind="stable")
                heads = np.flatnonzero(np.diff(rows[order], prepend=-1))
                table[rows[order][heads]] += np.add.reduceat(sums[order], heads, axis=0).astype(np.int64)
    used = np.flatnonzero(table.any(axis=1))
    yield pa.RecordBatch.from_arrays([pa.array(used), *(pa.array(c) for c in np.ascontiguousarray(table[used].T))], ["at", *_SUMS])


_SUMS = [f"s{k}" for k in range(DIM + 1)]


def context_vectors(texts: DataFrame) -> np.ndarray:
    """Unit context vectors of all table rows, from all texts of a one-column frame: (rows, DIM), 1 MB at any input size."""
    tasks = texts.mapInArrow(_context_tasks, "at long, " + ", ".join(f"{c} long" for c in _SUMS))
    found = tasks.groupBy("at").agg(*(F.sum(c).alias(c) for c in _SUMS)).toArrow()
    sums = np.zeros((WORD_ROWS + SHAPE_ROWS, DIM + 1))
    if found.num_rows:
        sums[found["at"].to_numpy()] = np.column_stack([found[c].to_numpy() for c in _SUMS])
    # Less what any word has around it.
    common = sums[:WORD_ROWS].sum(axis=0)
    vectors = sums[:, :DIM] - sums[:, DIM:] * (common[:DIM] / max(1.0, common[DIM]))
    return (vectors / (np.linalg.norm(vectors, axis=1, keepdims=True) + 10)).astype(np.float32)


def pool_texts(texts: pa.Array, table: np.ndarray) -> np.ndarray:
    """One row of ``FEATURES`` numbers per text; zeros for NULL, empty and wordless texts."""
    sums, counts = np.zeros((len(texts), FEATURES)), np.zeros(len(texts))
    squares = slice(DIM, 2 * DIM)
    for row, carried, piece in _pieces(texts):
        vectors = (table[piece.rows[0]] + table[piece.rows[1]])[piece.kind]
        index = piece.index[piece.kind] * np.float32(0.25)
        columns = np.zeros((len(vectors), FEATURES), dtype=np.float32)
        new = slice(carried, None)
        columns[new, :DIM], columns[new, squares], columns[new, 3 * DIM:4 * DIM] = vectors[new], np.square(vectors[new]), index[new]
        for lag in range(1, LAGS + 1):
            if len(vectors) <= lag:
                break
            here = piece.together(lag)
            here[:max(0, carried - lag)] = False
            # A pair counts for its second word.
            if lag == 1:
                columns[1:, 2 * DIM:3 * DIM][here] = vectors[:-1][here] * vectors[1:][here]
            columns[lag:, 4 * DIM + lag - 1][here] = np.einsum("ij,ij->i", index[:-lag][here], index[lag:][here])
        heads = np.flatnonzero(np.diff(piece.text_of, prepend=-1))
        at = row + piece.text_of[heads]
        sums[at] += np.add.reduceat(columns, heads, axis=0, dtype=np.float64)
        np.add.at(counts, row + piece.text_of[new], 1)
    out = sums / np.maximum(counts, 1)[:, None]
    out[:, squares] = np.sqrt(np.maximum(0, out[:, squares] - np.square(out[:, :DIM])))
    return out


def _forward(x: np.ndarray, net: dict) -> tuple[np.ndarray, np.ndarray]:
    hidden = np.tanh(x @ net["w1"] + net["b1"])
    return hidden, hidden @ net["w2"] + net["b2"]


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -60, 60)))


def _log_loss(z: np.ndarray, y: np.ndarray) -> float:
    return float(np.mean(np.logaddexp(0, np.where(y > 0, -z, z))))


def train(features: np.ndarray, labels: np.ndarray, seed: int = SEED) -> dict:
    """A network with one hidden layer, and its temperature. One class alone: its share, smoothed, as a constant."""
    labels = np.asarray(labels, dtype=np.float64)
    if len(set(labels.tolist())) < 2:
        share = (labels.sum() + 1) / (len(labels) + 2)
        return {"constant": float(np.log(share / (1 - share)))}
    rng = np.random.default_rng(seed)
    mean, spread = features.mean(axis=0), features.std(axis=0) + 1e-6
    x = (features - mean) / spread
    held = np.arange(len(x)) % 5 == 0
    if len(set(labels[~held].tolist())) < 2 or len(set(labels[held].tolist())) < 2:
        held = np.ones(len(x), dtype=bool)
        learnt = held
    else:
        learnt = ~held
    xs, ys = x[learnt], labels[learnt]
    net = {"w1": rng.normal(0, 1 / np.sqrt(x.shape[1]), (x.shape[1], HIDDEN)), "b1": np.zeros(HIDDEN), "w2": rng.normal(0, 1 / np.sqrt(HIDDEN), HIDDEN), "b2": np.zeros(())}
    first, second = {k: np.zeros_like(v) for k, v in net.items()}, {k: np.zeros_like(v) for k, v in net.items()}
    size = int(np.clip(len(xs) // 20, 8, 128))
    total, step = ROUNDS * -(-len(xs) // size), 0
    for _ in range(ROUNDS):
        order = rng.permutation(len(xs))
        for a in range(0, len(xs), size):
            part, y = xs[order[a:a + size]], ys[order[a:a + size]]
            hidden, z = _forward(part, net)
            slope = (_sigmoid(z) - y) / len(y)
            inner = slope[:, None] * net["w2"] * (1 - hidden ** 2)
            grads = {"w1": part.T @ inner + DECAY * net["w1"], "b1": inner.sum(axis=0), "w2": hidden.T @ slope + DECAY * net["w2"], "b2": slope.sum()}
            step += 1
            rate = RATE * (1 - step / (total + 1))
            for k, g in grads.items():
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.999 * second[k] + 0.001 * g * g
                net[k] = net[k] - rate * (first[k] / (1 - 0.9 ** step)) / (np.sqrt(second[k] / (1 - 0.999 ** step)) + 1e-8)
    _, z = _forward(x[held], net)
    return {"net": net, "mean": mean, "spread": spread, "temperature": best_temperature(z, labels[held])}


def best_temperature(z: np.ndarray, y: np.ndarray) -> float:
    """The divisor of the logits with the least log loss, between 1/20 and 20, by narrowing a bracket of its logarithm."""
    low, high = np.log(0.05), np.log(20.0)
    golden = (np.sqrt(5) - 1) / 2
    while high - low > 1e-4:
        a, b = high - golden * (high - low), low + golden * (high - low)
        if _log_loss(z / np.exp(a), y) <= _log_loss(z / np.exp(b), y):
            high = b
        else:
            low = a
    return float(np.exp((low + high) / 2))


def probabilities(features: np.ndarray, model: dict) -> np.ndarray:
    if "constant" in model:
        return np.full(len(features), _sigmoid(model["constant"]))
    _, z = _forward((features - model["mean"]) / model["spread"], model["net"])
    return _sigmoid(z / model["temperature"])


def training_fold() -> object:
    """True for ids that may be learnt from."""
    return F.crc32(F.col("doc_id").cast("string")) % 5 != 0


def fit(docs: DataFrame, labels: DataFrame) -> dict:
    """Context vectors of all of ``docs`` (doc_id, text) and the network from labelled rows outside the held-out fold.

    Labels other than 0 and 1 and rows without an id are passed over; an id labelled both ways counts as 1.
    """
    table = context_vectors(docs.select("text"))
    allowed = labels.select("doc_id", "quality").filter(training_fold() & F.col("quality").isin(0, 1))
    allowed = allowed.groupBy("doc_id").agg(F.max("quality").alias("quality"))
    picked = allowed.orderBy(F.xxhash64("doc_id"), "doc_id").limit(LABELLED)
    sample = docs.select("doc_id", "text").join(F.broadcast(picked), "doc_id").select("doc_id", F.col("quality").cast("int"), "text")

    def pool(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = pool_texts(batch.column(2), table)
            ends = pa.array(np.arange(0, found.size + 1, FEATURES, dtype=np.int32))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.ListArray.from_arrays(ends, pa.array(found.ravel()))], ["doc_id", "quality", "features"])

    # Repeats of a document are taken once, so at most LABELLED rows of FEATURES numbers come back.
    pooled = sample.mapInArrow(pool, "doc_id long, quality int, features array<double>")
    rows = pooled.groupBy("doc_id", "quality").agg(F.min("features").alias("features")).toArrow().sort_by("doc_id")
    features = np.array(rows["features"].to_pylist(), dtype=np.float64).reshape(rows.num_rows, FEATURES)
    return {"table": table} | train(features, rows["quality"].to_numpy())


def score_documents(docs: DataFrame, model: dict, text: str = "text", score: str = "quality_score") -> DataFrame:
    """``docs`` with a column ``score``: the probability of good quality, for every row, in place and without a shuffle.

    NULL, empty and wordless texts get the network's answer to no evidence. Very long texts are pooled whole, piece
    by piece. Without labels of both classes all texts score alike. Other columns and repeats are kept; a column
    that already has the name is replaced.
    """
    def score_batches(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for part in parts:
            yield pa.array(probabilities(pool_texts(part, model["table"]), model), pa.float64())

    return docs.withColumn(score, F.arrow_udf(score_batches, "double")(F.col(text)))


@query()
def op12_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    model = fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return score_documents(docs, model).select(
        "doc_id", F.coalesce(~training_fold(), F.lit(False)).alias("held_out"), F.col("quality_score").alias("score"),
        (F.col("quality_score") >= THRESHOLD).cast("int").alias("predicted"))
