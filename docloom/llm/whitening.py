"""Embedding whitening by Chebyshev-filtered subspace iteration over distributed passes.

A vector entry c becomes the integer ``floor(1024 c) + 100000``. The count n and the sums S per dimension are exact
integers; every later pass works on ``(n x - S) / n``, so the data is centred before anything is multiplied. The
covariance V is never formed: a pass multiplies it by a block Q of ``WANTED + GUARDS`` columns, each task adds up
``X'(X Q)`` over its rows, and Spark adds the tasks up in one aggregate of ``dimensions`` rows.

One round: a Chebyshev polynomial of V (a three-term recurrence, one pass per degree) damps everything below the
block's least Ritz value; QR; Rayleigh-Ritz. Rounds go on until the residuals of all wanted pairs are at the level of
double rounding. Then fresh random columns orthogonal to the found ones go through the same filter: a Ritz value among
them above the least wanted one would be a missed component and starts another round, otherwise the result is certified.

The driver holds a few blocks of dimensions x columns, whatever the number of rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom.llm.registry import query

SCALE, SHIFT = 1024, 100_000
WANTED, GUARDS, DEGREE = 8, 24, 12
ROUNDS, ROUNDING = 200, 4e-15  # a wanted residual below ROUNDING * sqrt(dimensions) * largest eigenvalue is rounding
RANK = 1e-12  # components with a smaller share of the variance have no direction of their own
LARGEST = 2.0 ** 40  # entries must be smaller than this, else x is no exact integer in double arithmetic
SLICE = 1 << 20  # entries worked on at once
SEED = 5
SCHEMA = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def integer_vectors(column: pa.Array, dimensions: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row numbers, x as int64 matrix) in slices, without vectors that are NULL, not finite or of another length."""
    lengths = pc.fill_null(pc.list_value_length(column), -1).to_numpy(zero_copy_only=False)
    rows = np.flatnonzero(lengths == dimensions)
    step = max(1, SLICE // max(1, dimensions))
    for a in range(0, len(rows), step):
        part = rows[a:a + step]
        flat = column.take(pa.array(part)).flatten()
        values = flat.to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(part), dimensions)
        with np.errstate(invalid="ignore"):
            usable = (np.abs(values) < LARGEST).all(axis=1)  # false for NaN, which NULL entries become too
        yield part[usable], np.floor(values[usable] * SCALE).astype(np.int64) + SHIFT


class Vectors:
    """The usable vectors of a frame and the passes over them."""

    def __init__(self, frame: DataFrame, vector: str):
        self.frame = frame.select(F.col(vector).alias("vector"))
        lengths = (self.frame.filter("vector IS NOT NULL AND size(vector) > 0").groupBy(F.size("vector").alias("size")).count()
                   .orderBy(F.desc("count"), F.desc("size")).first())
        self.dimensions = lengths["size"] if lengths else 0
        self.n, self.sums = 0, np.zeros(self.dimensions, dtype=np.int64)
        if self.dimensions:
            found = self._add_up(lambda x: np.column_stack([np.full(x.shape[1], len(x)), x.sum(axis=0)]), 2, "long")
            self.n, self.sums = int(found[0, 0]), found[:, 1]

    def _add_up(self, of, columns: int, kind: str, rows: int | None = None) -> np.ndarray:
        """Sum of the (rows x columns) arrays ``of(x)`` over all slices: per task in Python, over tasks by Spark."""
        dimensions, height = self.dimensions, self.dimensions if rows is None else rows
        dtype = np.int64 if kind == "long" else np.float64
        names = [f"c{j}" for j in range(columns)]

        def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros((height, columns), dtype)
            for batch in batches:
                for _, x in integer_vectors(batch.column(0), dimensions):
                    total += of(x)
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(height)), *(pa.array(c) for c in np.ascontiguousarray(total.T))], ["i", *names])

        tasks = self.frame.mapInArrow(add, "i long, " + ", ".join(f"{c} {kind}" for c in names))
        table = tasks.groupBy("i").agg(*(F.sum(c).alias(c) for c in names)).toArrow().sort_by("i")
        out = np.zeros((height, columns), dtype)
        if table.num_rows:
            out[table["i"].to_numpy()] = np.column_stack([table[c].to_numpy() for c in names])
        return out

    def covariance_times(self, q: np.ndarray) -> np.ndarray:
        """V q, in one pass."""
        n, sums = self.n, self.sums

        def multiply(x: np.ndarray) -> np.ndarray:
            centred = (n * x - sums) / n
            return centred.T @ (centred @ q)

        return self._add_up(multiply, q.shape[1], "double") / n

    def trace(self) -> float:
        n, sums = self.n, self.sums
        return float(self._add_up(lambda x: np.square((n * x - sums) / n).sum(axis=0)[:, None], 1, "double").sum() / n)

    def identity_error(self, project: np.ndarray) -> float:
        """Largest entry of the covariance of the projected vectors minus the identity; their mean is taken off first."""
        n, sums, width = self.n, self.sums, project.shape[1]
        if not width:
            return 0.0
        mean = self._add_up(lambda x: (((n * x - sums) / n) @ project).sum(axis=0)[None, :], width, "double", rows=1)[0] / n

        def multiply(x: np.ndarray) -> np.ndarray:
            whitened = ((n * x - sums) / n) @ project - mean
            return whitened.T @ whitened

        return float(np.abs(self._add_up(multiply, width, "double", rows=width) / n - np.eye(width)).max())


def chebyshev(times, q: np.ndarray, cut: float, top: float, degree: int) -> np.ndarray:
    """p(V) q for the Chebyshev polynomial that is at most 1 on eigenvalues 0..cut, scaled to 1 at ``top``."""
    half = cut / 2
    sigma = half / (top - half)
    last = 2 / sigma
    before, now = q, (times(q) - half * q) * (sigma / half)
    for _ in range(degree - 1):
        after = 1 / (last - sigma)
        before, now = now, (times(now) - half * now) * (2 * after / half) - sigma * after * before
        sigma = after
    return now


def rayleigh_ritz(times, q: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Falling Ritz values, Ritz vectors and residual norms of the span of ``q``."""
    q, _ = np.linalg.qr(q)
    image = times(q)
    small = q.T @ image
    values, turn = np.linalg.eigh((small + small.T) / 2)
    values, turn = values[::-1], turn[:, ::-1]
    q = q @ turn
    return values, q, np.linalg.norm(image @ turn - q * values, axis=0)


def leading_components(times, dimensions: int, wanted: int = WANTED, guards: int = GUARDS, degree: int = DEGREE, seed: int = SEED) -> tuple[np.ndarray, np.ndarray]:
    """The ``wanted`` largest eigenvalues of a symmetric non-negative operator and their unit vectors, certified."""
    rng = np.random.default_rng(seed)
    wanted = min(wanted, dimensions)
    width = min(dimensions, wanted + guards)
    values, q, residuals = rayleigh_ritz(times, rng.normal(size=(dimensions, width)))
    worst = np.inf
    for _ in range(ROUNDS):
        if values[0] <= 0:
            return values[:wanted], q[:, :wanted]  # no variance at all
        rounding = ROUNDING * np.sqrt(dimensions) * values[0]
        error = residuals[:wanted].max()
        if error <= rounding or error <= 100 * rounding and error > worst / 2:
            if width == dimensions:
                break
            probe = rng.normal(size=(dimensions, min(wanted, dimensions - wanted)))
            found = q[:, :wanted]
            off = lambda y: y - found @ (found.T @ y)
            rest = lambda y: off(times(off(y)))
            high, extra, _ = rayleigh_ritz(rest, chebyshev(rest, off(probe), max(values[-1], RANK * values[0]), values[0], degree))
            if high[0] <= values[wanted - 1] + 1e-9 * values[0]:
                break
            q = np.concatenate([q[:, :width - extra.shape[1]], extra], axis=1)  # a missed direction: go on with it
            error = np.inf
        worst = error
        cut = max(values[-1], RANK * values[0])
        q = chebyshev(times, q, cut, values[0], degree) if cut < values[0] else q
        values, q, residuals = rayleigh_ritz(times, q)
    else:
        raise ArithmeticError(f"components not certified: residual {worst:g} of {values[0]:g} after {ROUNDS} rounds")
    return values[:wanted], q[:, :wanted]


def whiten(frame: DataFrame, id: str = "vec_id", vector: str = "embedding", wanted: int = WANTED) -> DataFrame:
    """One row per usable vector and component (``SCHEMA``).

    ``frame`` must scan stored data, since it is read once per pass. A vector that is NULL, empty, of another length
    than most (ties: the longer), or that holds NULL, a non-finite entry or one of 2^40 and more, has no rows and no part
    in the fit. Ids may be NULL or repeat: every row has its own rows. Components without variance are left out, so
    equal vectors, or one alone, give none. ``deviation`` is NULL where the exact number is no 64-bit one. No usable
    vector: an empty frame. Other columns of ``frame`` are ignored, whatever their names.
    """
    spark = frame.sparkSession
    data = Vectors(frame, vector)
    if data.n == 0:
        return spark.createDataFrame([], SCHEMA)
    n, sums, dimensions = data.n, data.sums, data.dimensions
    trace = data.trace()
    if trace <= 0:
        return spark.createDataFrame([], SCHEMA)
    values, directions = leading_components(data.covariance_times, dimensions, wanted)
    held = values > RANK * trace
    values, directions = values[held], directions[:, held]
    project = directions / np.sqrt(values)
    explained, error, count = values / trace, data.identity_error(project), len(values)

    def deviations(x: np.ndarray) -> pa.Array:
        off = n * x - sums
        near = np.square(off.astype(np.float64)).sum(axis=1)
        fits = near < 2.0 ** 62
        exact = np.square(np.where(fits[:, None], off, 0)).sum(axis=1)
        whole = [int(v) if f else sum(int(o) ** 2 for o in row) for v, f, row in zip(exact, fits, off, strict=True)] if not fits.all() else exact.tolist()
        return pa.array([v if v < 1 << 63 else None for v in whole], pa.int64())

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, x in integer_vectors(batch.column(1), dimensions):
                each = pa.array(np.repeat(np.arange(len(rows)), count))
                whitened = ((n * x - sums) / n) @ project
                size = len(rows) * count
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(rows)).take(each), pa.array(np.tile(np.arange(1, count + 1, dtype=np.int32), len(rows))),
                     pa.array(np.full(size, n)), deviations(x).take(each), pa.array(whitened.ravel()),
                     pa.array(np.tile(explained, len(rows))), pa.array(np.full(size, error))],
                    ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return frame.select(F.col(id).cast("long"), F.col(vector)).mapInArrow(emit, SCHEMA)


@query()
def op11_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
