"""Pieces of the quality classifier: small enough for a core's cache, and without effect on what is pooled."""

import random

import numpy as np
import pyarrow as pa
from docloom.llm import quality_classifier as quality


def test_columns_of_a_piece_stay_small():
    assert quality.PIECE * quality.FEATURES * 4 <= 4 << 20


def test_pieces_do_not_change_what_is_pooled(monkeypatch):
    rng = random.Random(12)
    texts = pa.array([" ".join(rng.choice(["Alpha", "beta.", "x1", "é"]) for _ in range(n)) for n in (9000, 0, 3, 1, 400)] + [None])
    table = np.random.default_rng(1).normal(0, 0.1, (quality.WORD_ROWS + quality.SHAPE_ROWS, quality.DIM)).astype(np.float32)

    def both():
        sums = [b for b in quality._context_tasks(iter([pa.record_batch([texts], ["text"])]))]
        return quality.pool_texts(texts, table), sums[0].to_pydict()

    small = both()
    monkeypatch.setattr(quality, "PIECE", 1 << 17)
    whole = both()
    assert np.allclose(small[0], whole[0], atol=1e-9) and small[1] == whole[1]
