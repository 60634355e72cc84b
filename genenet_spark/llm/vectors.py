"""Whole-number vectors: validity, exact sums in limbs, and tables of blocks that numpy reads at once."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LIMB_BITS = 31
LIMBS = 5
BLOCK_ROWS = 1024
#: Below this magnitude the squares of a vector's components, and a block's sums of them, stay inside 64 bits.
SAFE = 1 << 26


def all_finite(vector: Column) -> Column:
    """True where a vector is there and no component of it is null, NaN or infinite."""
    good = F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))
    return vector.isNotNull() & F.coalesce(good, F.lit(False))


def whole(vector: Column, factor: int) -> Column:
    """``floor(factor * component)`` as longs; beyond the range of longs Spark's ``floor`` stays at its end."""
    return F.transform(vector, lambda c: F.floor(c.cast("double") * F.lit(float(factor))).cast("long"))


def matrix(column: pa.Array, dim: int) -> np.ndarray:
    """The rows of a list column of equal lengths as a matrix of longs."""
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64, copy=False).reshape(-1, dim)


def wide(x: np.ndarray) -> np.ndarray:
    """``x`` as it is where squares and their sums fit 64 bits, otherwise as Python's unbounded integers."""
    return x if not x.size or (x.max() < SAFE and x.min() > -SAFE) else x.astype(object)


def to_limbs(values: Sequence[int]) -> list[list[int]]:
    """Whole numbers as ``LIMBS`` lists of limbs; all limbs but the highest are not negative."""
    out: list[list[int]] = []
    rest = [int(v) for v in values]
    for _ in range(LIMBS - 1):
        out.append([v & ((1 << LIMB_BITS) - 1) for v in rest])
        rest = [v >> LIMB_BITS for v in rest]
    return [*out, rest]


def from_limbs(limbs: Sequence[int]) -> int:
    return sum(int(v) << (LIMB_BITS * i) for i, v in enumerate(limbs))


LIMB_SCHEMA = ", ".join(f"l{i} long" for i in range(LIMBS))


def sum_limbs(rows: DataFrame, *keys: str) -> dict[tuple, int]:
    """Exact sums of limb rows by key: partial sums in every task, in any order, then one row a key for the driver."""
    summed = rows.groupBy(*keys).agg(*(F.sum(f"l{i}").alias(f"l{i}") for i in range(LIMBS)))
    return {tuple(r[k] for k in keys): from_limbs([r[f"l{i}"] for i in range(LIMBS)]) for r in summed.collect()}


def limb_batch(keys: dict[str, pa.Array], values: Sequence[int]) -> pa.RecordBatch:
    limbs = [pa.array(column, pa.int64()) for column in to_limbs(values)]
    return pa.RecordBatch.from_arrays([*keys.values(), *limbs], names=[*keys, *(f"l{i}" for i in range(LIMBS))])


def rows_of_blocks(batches: Iterator[pa.RecordBatch], dim: int) -> Iterator[np.ndarray]:
    """The matrices of a stored table of blocks, one block at a time."""
    for batch in batches:
        for block in batch.column(0):
            yield np.frombuffer(block.as_buffer(), np.int64).reshape(-1, dim)


def fold(rows: DataFrame, most: int) -> np.ndarray:
    """The sum of the ``sums`` arrays of at most ``most`` rows, added in the order of ``part`` whatever task ends first.

    Sixty-four neighbours are added to one on the executors until no more than 256 rows are left for the driver.
    """
    while most > 256:
        near = rows.groupBy(F.expr("part div 64").alias("part")).agg(F.sort_array(F.collect_list(F.struct("part", "sums"))).alias("a"))
        added = F.aggregate(F.slice("a", 2, 64), F.col("a")[0]["sums"], lambda s, r: F.zip_with(s, r["sums"], lambda x, y: x + y))
        rows, most = near.select("part", added.alias("sums")), -(-most // 64)
    total = None
    for r in sorted(rows.collect(), key=lambda r: r["part"]):
        part = np.array(r["sums"], np.float64)
        total = part if total is None else total + part
    return total
