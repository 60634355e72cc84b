"""Embedding whitening (operator 11): Chebyshev-filtered subspace iteration.

The covariance matrix is never formed. A pass over the stored vectors gives its product
with a narrow block of columns; a Chebyshev polynomial of such products damps the unwanted
part of the spectrum, a QR step and a Rayleigh-Ritz step follow, and rounds go on until the
residuals certify the wanted eigenvectors.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from decimal import Decimal
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from genenet_spark.llm.common import discard, freeze, map_batches
from genenet_spark.llm.vectors import (BLOCK_ROWS, LIMB_SCHEMA, all_finite, fold, limb_batch, matrix, rows_of_blocks, sum_limbs, whole,
                                       wide)

FACTOR = 256
COMPONENTS = 4
#: Columns beyond the wanted ones: the wider the block, the larger the gap that the filter works with.
GUARD = 12
#: A residual of this share of the largest eigenvalue certifies an eigenvector.
CERTIFIED = 1e-13
#: The rounding of long sums can keep a residual above ``CERTIFIED``; one that no longer falls is good enough below this.
SETTLED = 1e-11
#: A filter may raise the first column over the last by this factor before the columns are made orthogonal again.
SPREAD = 1e9
DEGREE = 16
ROUNDS = 200
#: Seed of the first block of columns (fixed value).
SEED = 11


class Whitening:
    """A fitted model: ``n`` vectors, sums ``total`` by dimension, eigenpairs, and how far whitened data are from identity."""

    def __init__(self, n: int, total: list[int], values: np.ndarray, vectors: np.ndarray, trace: float, identity_error: float, passes: int):
        self.n, self.total, self.values, self.vectors = n, total, values, vectors
        self.trace, self.identity_error, self.passes = trace, identity_error, passes


def _pack(dim: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = matrix(batch.column(0), dim)
            blocks = [x[i : i + BLOCK_ROWS].tobytes() for i in range(0, len(x), BLOCK_ROWS)]
            yield pa.RecordBatch.from_arrays([pa.array(blocks, pa.binary())], names=["block"])

    return run


def _moments(dim: int):
    """Exact count, sums (``which`` 0) and sums of squares (1) of a task's vectors by dimension."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, blocks, sums, squares = 0, 0, [0] * dim, [0] * dim
        for x in rows_of_blocks(batches, dim):
            count, blocks, x = count + len(x), blocks + 1, wide(x)
            sums = [a + int(b) for a, b in zip(sums, x.sum(axis=0))]
            squares = [a + int(b) for a, b in zip(squares, (x * x).sum(axis=0))]
        which = pa.array([0] * dim + [1] * dim + [2, 3], pa.int32())
        at = pa.array([*range(dim), *range(dim), 0, 0], pa.int32())
        yield limb_batch({"which": which, "at": at}, [*sums, *squares, count, blocks])

    return run


def _partial(dim: int, work):
    """One row of sums a task: ``work(x)`` of every block, added up in the order of the stored table."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for x in rows_of_blocks(batches, dim):
            part = work(x)
            total = part if total is None else total + part
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([total.ravel()], pa.list_(pa.float64()))], names=["sums"])

    return run


class _Pass:
    """Passes over the stored blocks of the fit list."""

    def __init__(self, blocks: DataFrame, dim: int, count: int, mean: np.ndarray, n: int):
        self.blocks, self.dim, self.count, self.mean, self.n, self.passes = blocks, dim, count, mean, n, 0

    def _sum(self, work) -> np.ndarray:
        self.passes += 1
        rows = map_batches(self.blocks, _partial(self.dim, work), "sums array<double>").withColumn("part", F.spark_partition_id())
        return fold(rows, self.count)

    def product(self, q: np.ndarray) -> np.ndarray:
        """The covariance times ``q``: centred vectors meet ``q``, then each other."""
        mean = self.mean

        def work(x: np.ndarray) -> np.ndarray:
            c = x - mean
            return c.T @ (c @ q)

        return self._sum(work).reshape(q.shape) / self.n

    def whitened_covariance(self, turn: np.ndarray) -> np.ndarray:
        mean, k = self.mean, turn.shape[1]

        def work(x: np.ndarray) -> np.ndarray:
            w = (x - mean) @ turn
            return np.vstack([w.sum(axis=0), w.T @ w])

        sums = self._sum(work).reshape(k + 1, k)
        middle = sums[0] / self.n
        return sums[1:] / self.n - np.outer(middle, middle)


def _filtered(run: _Pass, x: np.ndarray, ax: np.ndarray, low: float, high: float, top: float, degree: int) -> np.ndarray:
    """Chebyshev polynomial of the covariance on ``x``: small on [low, high], one at ``top``; ``ax`` is the first product."""
    half, middle = (high - low) / 2, (high + low) / 2
    first = half / (top - middle)
    sigma = first
    before, now = x, (ax - middle * x) * (sigma / half)
    for _ in range(degree - 1):
        after = 1 / (2 / first - sigma)
        before, now = now, 2 * (after / half) * (run.product(now) - middle * now) - sigma * after * before
        sigma = after
    return now


def _degree(values: np.ndarray, wanted: int, high: float, worst: float) -> int:
    """As many factors as the last wanted column needs, as long as the first one does not drown the others."""
    spread = [math.acosh(max(1.0, 2 * v / high - 1)) for v in (values[0], values[wanted - 1])]
    need = math.log(max(10.0, worst / CERTIFIED)) / max(spread[1], 1e-3)
    safe = math.log(SPREAD) / max(spread[0] - spread[1], 1e-3)
    return int(max(1, min(DEGREE, need + 1, safe)))


def _eigenpairs(run: _Pass, wanted: int) -> tuple[np.ndarray, np.ndarray]:
    """The largest eigenvalues of the covariance and unit eigenvectors, certified by their residuals."""
    wide_block = min(run.dim, wanted + GUARD)
    q = np.linalg.qr(np.random.default_rng(SEED).standard_normal((run.dim, wide_block)))[0]
    last = math.inf
    for _ in range(ROUNDS):
        aq = run.product(q)
        small = q.T @ aq
        values, turn = np.linalg.eigh((small + small.T) / 2)
        values, turn = values[::-1], turn[:, ::-1]
        x, ax = q @ turn, aq @ turn
        top = values[0]
        if not top > 0:
            return np.zeros(wanted), x[:, :wanted]  # all vectors are equal
        worst = float(np.linalg.norm(ax[:, :wanted] - x[:, :wanted] * values[:wanted], axis=0).max()) / top
        if worst <= CERTIFIED or (worst <= SETTLED and worst > last / 2):
            return np.maximum(values[:wanted], 0), x[:, :wanted]
        last = worst
        high = values[-1]
        # A block that holds all of the spectrum that is not zero needs no filter, only another product.
        grown = ax if high <= 1e-13 * top else _filtered(run, x, ax, 0.0, high, top, _degree(values, wanted, high, worst))
        q = np.linalg.qr(grown)[0]
    raise RuntimeError(f"whitening: residual {last} of the largest eigenvalue after {ROUNDS} rounds")


def _valid(rows: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    good = rows.where(all_finite(F.col(vector_col)))
    return good.select(F.col(id_col).cast("long").alias("vec_id"), whole(F.col(vector_col), FACTOR).alias("x"))


def _common_length(valid: DataFrame) -> int:
    """The length that most vectors have; the greater one where two are as frequent. Lengths are few: a row each."""
    sizes = valid.groupBy(F.size("x").alias("dim")).agg(F.count(F.lit(1)).alias("n")).collect()
    return max(((r["n"], r["dim"]) for r in sizes if r["dim"] > 0), default=(0, 0))[1]


def fit(vectors: DataFrame, dim: int, components: int = COMPONENTS) -> Whitening | None:
    """Learn from ``vectors(x array<long>)`` of length ``dim``, each distinct one once; None without any."""
    blocks = freeze(map_batches(vectors.select("x").distinct(), _pack(dim), "block binary"), "vector-blocks")
    found = sum_limbs(map_batches(blocks, _moments(dim), f"which int, at int, {LIMB_SCHEMA}"), "which", "at")
    n = found.get((2, 0), 0)
    if n:
        total, squares = [found[0, i] for i in range(dim)], [found[1, i] for i in range(dim)]
        run = _Pass(blocks, dim, found[3, 0], np.array([float(Fraction(s, n)) for s in total]), n)
        trace = float(sum(Fraction(n * s2 - s * s, n * n) for s, s2 in zip(total, squares)))
        values, axes = _eigenpairs(run, min(components, dim))
        kept = values > CERTIFIED * max(values[0], 0.0)
        scaled = axes[:, kept] / np.sqrt(values[kept])
        error = float(np.abs(run.whitened_covariance(scaled) - np.eye(scaled.shape[1])).max()) if kept.any() else 0.0
        model = Whitening(n, total, np.where(kept, values, 0.0), axes, trace, error, run.passes)
    discard(blocks)
    return model if n else None


def _deviations(x: np.ndarray, n: int, total: list[int]) -> list[int]:
    """Sum over dimensions of (n * x - S)^2, exact: squared out, with S in limbs so that products stay inside 64 bits."""
    x = wide(x)
    inner = [0] * len(x)
    limbs = [[(abs(s) >> (24 * i)) & ((1 << 24) - 1) for s in total] for i in range(max(1, -(-max(abs(s) for s in total).bit_length() // 24)))]
    signs = np.array([-1 if s < 0 else 1 for s in total])
    for i, limb in enumerate(limbs):
        inner = [a + (int(b) << (24 * i)) for a, b in zip(inner, (x * (signs * np.array(limb))).sum(axis=1))]
    squares, own = (x * x).sum(axis=1), sum(s * s for s in total)
    return [n * n * int(a) - 2 * n * b + own for a, b in zip(squares, inner)]


OUT_SCHEMA = ("vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double, "
              "deviation_exact decimal(38,0)")


def _whitener(model: Whitening, dim: int):
    n, total, values, axes = model.n, model.total, model.values, model.vectors
    mean = np.array([float(Fraction(s, n)) for s in total])
    scale = np.array([1 / math.sqrt(v) if v > 0 else math.nan for v in values])
    share = [float(v / model.trace) if model.trace > 0 else 0.0 for v in values]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = len(values)
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK_ROWS):
                part = batch.slice(at, BLOCK_ROWS)
                x = matrix(part.column(1), dim)
                w = ((x - mean) @ axes) * scale
                exact = _deviations(x, n, total)
                ids = [v for v in part.column(0).to_pylist() for _ in range(k)]
                yield pa.RecordBatch.from_arrays([
                    pa.array(ids, pa.int64()), pa.array([*range(1, k + 1)] * len(x), pa.int32()), pa.array([n] * len(ids), pa.int64()),
                    pa.array([v if v < 1 << 63 else None for v in exact for _ in range(k)], pa.int64()),
                    pa.array(w.ravel(), pa.float64(), from_pandas=True), pa.array(share * len(x), pa.float64()),
                    pa.array([model.identity_error] * len(ids), pa.float64()),
                    pa.array([Decimal(v) if v < 10**38 else None for v in exact for _ in range(k)], pa.decimal128(38, 0)),
                ], names=[f.split()[0] for f in OUT_SCHEMA.split(", ")])

    return run


def whiten(vectors: DataFrame, components: int = COMPONENTS, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """Every valid row projected on the ``components`` leading axes of the whitened space, a row for each axis.

    ``n`` distinct vectors were fitted; ``deviation`` is the exact sum of (n * x - S)^2 over the dimensions (null where it
    leaves the range of longs; ``deviation_exact`` has it to 38 digits); ``explained`` is the axis' share of the variance;
    ``identity_error`` the largest entry of whitened's covariance minus the identity.

    Cases: vectors that are null or hold null, NaN or infinite entries are dropped; so are those whose length is not the
    most frequent one, and empty ones, as they share no axes with the rest. Rows that repeat come back each, but are
    fitted once. With fewer dimensions than ``components`` there are as many axes as dimensions. An axis without variance
    (all vectors equal, fewer vectors than axes) has ``whitened`` null and ``explained`` 0. A null id stays null. Extra
    columns are ignored. An empty table gives no rows.
    """
    valid = _valid(vectors, id_col, vector_col)
    dim = _common_length(valid)
    valid = valid.where(F.size("x") == dim)
    model = fit(valid, dim, components) if dim else None
    if model is None:
        return vectors.sparkSession.createDataFrame([], OUT_SCHEMA)
    return map_batches(valid, _whitener(model, dim), OUT_SCHEMA)
