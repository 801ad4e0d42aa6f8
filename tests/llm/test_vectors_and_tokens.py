"""Embedding whitening, quality classifier and cross-tokenizer alignment: against brute force on small fixtures."""

import hashlib
import pickle
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from docloom.llm import cross_tokenizer, jaccard_join, quality_classifier, toxicity, whitening, wordhash
from pyspark import cloudpickle

LONG = 80  # vectors of a test table


def vectors(seed=1, rows=LONG, dimensions=12):
    rng = np.random.default_rng(seed)
    return (rng.normal(size=(rows, dimensions)) * np.linspace(3, 0.2, dimensions)).astype(np.float32)


def exact(values, wanted=8):
    x = np.floor(1024 * values.astype(np.float64)).astype(np.int64) + 100000
    n, sums = len(x), x.sum(axis=0)
    centred = (n * x - sums) / n
    spectrum, directions = np.linalg.eigh(centred.T @ centred / n)
    spectrum, directions = spectrum[::-1], directions[:, ::-1][:, :wanted]
    return np.square(n * x - sums).sum(axis=1), centred @ directions / np.sqrt(spectrum[:wanted]), spectrum[:wanted] / spectrum.sum()


def test_whitening_equals_a_dense_solver(spark):
    values = vectors()
    rows = [(i, v.tolist(), None, "x") for i, v in enumerate(values)]
    odd = [(900, None, 1, "x"), (901, [None] + [1.0] * 11, 1, "x"), (902, [float("nan")] + [0.0] * 11, 1, "x"), (903, [float("inf")] * 12, 1, "x"),
           (904, [], 1, "x"), (905, [1.0, 2.0], 1, "x"), (906, [1e30] * 12, 1, "x")]
    frame = spark.createDataFrame(rows + odd, "vec_id long, embedding array<float>, component int, n string")
    got = whitening.whiten(frame).toPandas()
    deviation, whitened, explained = exact(values)
    assert len(got) == LONG * 8 and set(got.n) == {LONG} and set(got.vec_id) == set(range(LONG))
    table = got.pivot(index="vec_id", columns="component", values="whitened").to_numpy()
    sign = np.sign((table * whitened).sum(axis=0))
    assert np.abs(table * sign - whitened).max() < 1e-9
    assert (got.groupby("vec_id").deviation.first().to_numpy() == deviation).all()
    assert np.allclose(got.groupby("component").explained.first(), explained, rtol=1e-12)
    assert got.identity_error.nunique() == 1 and got.identity_error.iloc[0] < 1e-10


def test_whitening_of_tables_without_spread(spark):
    schema = "vec_id long, embedding array<double>"
    assert whitening.whiten(spark.createDataFrame([], schema)).count() == 0
    assert whitening.whiten(spark.createDataFrame([(1, None)], schema)).count() == 0
    assert whitening.whiten(spark.createDataFrame([(1, [1.0, 2.0])] * 3, schema)).count() == 0
    # One direction only, a repeated row, a NULL id.
    line = whitening.whiten(spark.createDataFrame([(None, [1.0, 1.0]), (7, [2.0, 2.0]), (7, [2.0, 2.0]), (8, [4.0, 4.0])], schema)).collect()
    assert sorted((r.vec_id or 0, r.component) for r in line) == [(0, 1), (7, 1), (7, 1), (8, 1)]
    assert line[0].explained == pytest.approx(1)


def test_whitening_gives_no_number_that_does_not_fit(spark):
    rows = [(i, [float(2 ** 30 * i), float(i % 7)]) for i in range(40)]
    got = whitening.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).toPandas()
    x = np.array([[1024 * 2 ** 30 * i + 100000, 1024 * (i % 7) + 100000] for i in range(40)], dtype=object)
    sums = x.sum(axis=0)
    for r in got.itertuples():
        true = sum(int(40 * a - s) ** 2 for a, s in zip(x[r.vec_id], sums, strict=True))
        assert (r.deviation == true) if true < 2 ** 53 else np.isnan(r.deviation) or r.deviation == pytest.approx(true, rel=1e-12)


@pytest.mark.parametrize("dimensions,guards", [(40, 4), (40, 24), (9, 24), (3, 2)])
def test_components_are_found_and_certified(dimensions, guards):
    rng = np.random.default_rng(dimensions)
    basis, _ = np.linalg.qr(rng.normal(size=(dimensions, dimensions)))
    spectrum = np.sort(rng.uniform(0, 1, dimensions))[::-1] + np.linspace(0.5, 0, dimensions)
    matrix = (basis * spectrum) @ basis.T
    values, q = whitening.leading_components(lambda y: matrix @ y, dimensions, guards=guards)
    wanted = min(8, dimensions)
    assert np.allclose(values, spectrum[:wanted], rtol=1e-12)
    assert np.abs(matrix @ q - q * values).max() < 1e-12


# ---------------------------------------------------------------------------------------------- cross tokenizer

WORDS = cross_tokenizer.Vocabularies(cross_tokenizer.TOKENIZERS)


def plain(text):
    """(n_a, n_b, groups) from whole-text encodings and set intersection of ends; None when a vocabulary changes the text."""
    raw = (" " + (text or "")).encode()
    a = WORDS.a.encode(" " + (text or ""), add_special_tokens=False).ids
    b = WORDS.b.encode(text or "")
    if not text or any(b"".join(v[i] for i in ids) != raw for v, ids in ((WORDS.bytes_a, a), (WORDS.bytes_b, b))):
        return None
    ends = [np.cumsum(lengths[ids]).tolist() for lengths, ids in ((WORDS.length_a, a), (WORDS.length_b, b))]
    groups, low = [], 0
    for cut in sorted(set(ends[0]) & set(ends[1])):
        groups.append(tuple([i for i, e in zip(ids, at, strict=True) if low < e <= cut] for ids, at in zip((a, b), ends, strict=True)))
        low = cut
    return len(a), len(b), groups


def expected(rows):
    parts = [plain(t) for _, t in rows]
    counts = {}
    for p in parts:
        for pair in {(x, y) for a, b in (p[2] if p else []) for x in a for y in b}:
            counts[pair] = counts.get(pair, 0) + 1
    best = {}
    for (a, _), c in counts.items():
        best[a] = max(best.get(a, 0), c)
    out = []
    for (doc, _), p in zip(rows, parts, strict=True):
        if p is None:
            out.append((doc, 0, 0, 0, 0, 0, 0, ""))
            continue
        links = [(x, y) for a, b in p[2] for x in a for y in b]
        text = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in p[2])
        out.append((doc, p[0], p[1], len(p[2]), len(links), sum(counts[x] == best[x[0]] for x in links), sum(counts[x] for x in links),
                    hashlib.sha256(text.encode()).hexdigest()))
    return sorted(out, key=str), counts


def odd_texts():
    rng = random.Random(3)
    letters = "ab é\n\t .,'!▁日ñ   🎉 0129<>|\x00\xa0 \x1c"
    texts = [None, "", " ", "  ", "x ", " x", "<|endoftext|> a </s> <0x0A> <s>", "it's I'll", "日本語 テキスト", "🎉🎉🎉 x", "=" * 500 + " " * 300 + "=" * 77,
             "a  b  c\x1c d\x85 e", "Ünï  cödé  ñ", "a" * 3000, "same words again", "same words again", "ключ 密码 مفتاح"]
    return texts + ["".join(rng.choice(letters) for _ in range(rng.randrange(50))) for _ in range(400)]


@pytest.mark.parametrize("travel", [1 << 20, 50])
def test_alignment_equals_brute_force(spark, travel):
    rows = [(None if i == 5 else i // 2, t) for i, t in enumerate(odd_texts())]
    frame = spark.createDataFrame([(*r, 7, "k") for r in rows], "doc_id long, text string, n_a int, keys string")
    documents, pairs = cross_tokenizer.align(frame, travel=travel)
    want, counts = expected(rows)
    assert sorted((tuple(r) for r in documents.collect()), key=str) == want
    assert {(r.a, r.b): r.documents for r in pairs.collect()} == counts
    assert documents.dtypes == [tuple(c.replace("long", "bigint").split()) for c in cross_tokenizer.COLUMNS.split(", ")]


def test_alignment_of_an_empty_table(spark):
    documents, pairs = cross_tokenizer.align(spark.createDataFrame([], "doc_id long, text string"))
    assert documents.count() == 0 and pairs.count() == 0


def test_cuts_are_all_common_ends():
    rng = np.random.default_rng(4)
    for _ in range(200):
        ends, last = [[], []], [[], []]
        at = 0
        for _ in range(rng.integers(1, 5)):
            length = int(rng.integers(1, 400))
            for side in range(2):
                share = rng.choice([0.02, 0.3, 0.9])
                inner = np.flatnonzero(rng.random(length) < share) + 1
                ends[side].extend((at + np.union1d(inner[inner < length], [length])).tolist())
                last[side].append(len(ends[side]) - 1)
            at += length
        a, b = np.array(ends[0]), np.array(ends[1])
        cut_a, cut_b = cross_tokenizer.shared_cuts(a, b, np.array(last[0]), np.array(last[1]))
        assert (cut_a == np.isin(a, b)).all() and (cut_b == np.isin(b, a)).all()


def test_words_are_forgotten_without_a_trace(monkeypatch):
    texts = [t for t in odd_texts() if t]
    array, digits = pa.array(texts), cross_tokenizer._digits(50300)
    results = []
    for limit in (1 << 30, 1):
        monkeypatch.setattr(cross_tokenizer, "REMEMBERED", limit)
        words = cross_tokenizer.Vocabularies(cross_tokenizer.TOKENIZERS)
        found = []
        for part in (array.slice(0, 100), array.slice(100), array.slice(50, 100)):
            for _, data, offsets in wordhash.text_blocks(part):
                found.append({k: np.asarray(v).tolist() for k, v in cross_tokenizer.align_block(data, offsets, words, digits).items()})
        results.append(found)
    assert results[0] == results[1]


# ------------------------------------------------------------------------------------------- quality classifier


def quality_table(rng, n, first=0):
    words = ["river", "stone", "walks", "under", "bright", "morning", "light", "children", "seldom", "answer", "the", "of", "and", "a", "to"]
    rows = []
    for i in range(first, first + n):
        text = [rng.choice(words) + rng.choice(["", "", "s", "ing"]) for _ in range(rng.randrange(30, 90))]
        bad = i % 5 == 0
        if bad:
            text = [w.upper() + "!!" for w in text] if i % 2 else [w for w in text[:12] for _ in range(6)]
        rows.append((i, " ".join(text), 0 if bad else 1))
    return rows


def test_quality_is_learnt_and_held_out(spark):
    rows = quality_table(random.Random(2), 700)
    extra = [(9000, None, None), (9001, "", None), (9002, " \n ", None), (None, "no id", None), (9003, "word " * 300_000, None), (9004, rows[1][1], None), (9004, rows[1][1], None)]
    docs = spark.createDataFrame([(d, t, "x", 1.0) for d, t, _ in rows + extra], "doc_id long, text string, quality string, features double")
    labels = spark.createDataFrame([(d, q) for d, _, q in rows] + [(3, 1), (None, 1), (5, None), (9000, 5)], "doc_id long, quality int")
    model = quality_classifier.fit(docs, labels)
    scored = quality_classifier.score_documents(docs, model)
    assert scored.columns == [*docs.columns, "quality_score"]
    got = [(r.doc_id, r.quality_score) for r in scored.collect()]
    assert len(got) == len(rows) + len(extra) and all(0 <= s <= 1 for _, s in got)
    held = [(s, q) for (d, s), (_, _, q) in zip(sorted(g for g in got if g[0] is not None and g[0] < 9000), rows, strict=True) if zlib.crc32(str(d).encode()) % 5 == 0]
    assert len(held) > 80 and np.mean([(s >= quality_classifier.THRESHOLD) == (q == 1) for s, q in held]) > 0.97
    blank = {s for d, s in got if d in (9000, 9001, 9002)}
    assert len(blank) == 1
    assert 0.05 < model["temperature"] < 20
    assert max(len(cloudpickle.dumps(quality_classifier.score_documents)), len(pickle.dumps(model["net"]))) < 1 << 20


def test_quality_without_labels_or_documents(spark):
    docs = spark.createDataFrame([(1, "some words"), (2, None)], "doc_id long, text string")
    labels = spark.createDataFrame([], "doc_id long, quality int")
    model = quality_classifier.fit(docs, labels)
    assert {r.quality_score for r in quality_classifier.score_documents(docs, model).collect()} == {0.5}
    assert quality_classifier.score_documents(docs.limit(0), quality_classifier.fit(docs.limit(0), labels)).count() == 0


def test_pooling_does_not_depend_on_pieces(monkeypatch):
    rng = random.Random(5)
    texts = pa.array([None, "", "one", "a b", *(" ".join(rng.choice(["Aa", "b.", "cc#", "é"]) for _ in range(rng.randrange(200))) for _ in range(30))])
    batch = pa.RecordBatch.from_arrays([texts], ["text"])
    tables, pooled = [], []
    for size in (1 << 17, 7, 1):
        monkeypatch.setattr(quality_classifier, "PIECE", size)
        found = next(quality_classifier._context_tasks(iter([batch])))
        tables.append(sorted(zip(*(c.to_pylist() for c in found.columns), strict=True)))
        table = np.random.default_rng(1).normal(size=(quality_classifier.WORD_ROWS + quality_classifier.SHAPE_ROWS, quality_classifier.DIM)).astype(np.float32)
        pooled.append(quality_classifier.pool_texts(texts, table))
    assert tables[0] == tables[1] == tables[2]
    assert np.allclose(pooled[0], pooled[1], atol=1e-5) and np.allclose(pooled[0], pooled[2], atol=1e-5)
    # Against a plain loop: context sums and the products of neighbours.
    index = {}
    for t in texts.to_pylist():
        for piece in [p for _, _, p in quality_classifier._pieces(pa.array([t]))]:
            for w, k in zip((t or "").split(" "), piece.kind, strict=False):
                index.setdefault(w, (piece.index[k], piece.rows[0][k]))
    sums = {}
    for t in texts.to_pylist():
        words = (t or "").split()
        for i, w in enumerate(words):
            for j in range(max(0, i - 2), min(len(words), i + 3)):
                if i != j:
                    sums[index[w][1]] = sums.get(index[w][1], 0) + index[words[j]][0]
    found = {r[0]: np.array(r[1:-1]) for r in tables[0]}
    assert all((found[row] == total).all() for row, total in sums.items() if np.any(total))


def test_temperature_makes_probabilities_honest():
    rng = np.random.default_rng(1)
    z = rng.normal(size=4000) * 2
    y = (rng.random(4000) < 1 / (1 + np.exp(-z))).astype(float)
    assert quality_classifier.best_temperature(z * 5, y) == pytest.approx(5, rel=0.1)


# ------------------------------------------------------------------------------------------------ task functions


def test_task_functions_stay_small_after_fitting(spark):
    rng = random.Random(4)
    texts = [" ".join(rng.choice(["alpha", "beta", "gamma", "delta"]) for _ in range(3000)) for _ in range(200)]
    toxicity.train(texts, np.arange(200) % 2, rounds=(1, 1))
    wordhash.shingle_sets(pa.array(texts)).__next__()
    assert len(cloudpickle.dumps(jaccard_join._home_tasks)) < 1 << 20
    assert len(cloudpickle.dumps(wordhash.span_hashes)) < 1 << 20


def test_hashes_of_long_data_equal_those_of_short(monkeypatch):
    rng = np.random.default_rng(2)
    data = rng.integers(0, 256, 5000).astype(np.uint8)
    starts = np.sort(rng.integers(0, 4800, 900))
    ends = starts + rng.integers(0, 200, 900)
    whole = wordhash.span_hashes(data, starts, ends)
    monkeypatch.setattr(wordhash, "BLOCK_BYTES", 300)
    assert (wordhash.span_hashes(data, starts, ends) == whole).all()
    order = rng.permutation(900)
    assert (wordhash.span_hashes(data, starts[order], ends[order]) == whole[order]).all()
