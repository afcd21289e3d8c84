"""Vectors of an ``embedding`` column as whole numbers, and flat arrays of them inside Arrow batches."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Scaled components stop here. Up to it every result is exact; a result beyond 64 bits is given as the nearest long.
LIMIT = 1 << 40
LONG = (1 << 63) - 1


def whole_vectors(df: DataFrame, scale: int, multiple: int, carried: list[str]) -> tuple[DataFrame, int]:
    """(rows with ``carried`` and ``v`` array<long>, dimension) for vectors that are neither null nor hold null, NaN or infinity.

    A component x is floor(scale * x). Vectors are filled with zeros to one length, the longest one's rounded up to
    a ``multiple``; where all have the same fitting length, nothing is filled.
    """
    inside = F.forall("embedding", lambda x: x.isNotNull() & (F.abs(x) < F.lit(float("inf"))))
    kept = df.where(inside)
    shortest, longest = kept.agg(F.min(F.size("embedding")), F.max(F.size("embedding"))).first()
    dimension = -(-(longest or 0) // multiple) * multiple

    def whole(x):
        scaled = x.cast("double") * F.lit(float(scale))
        return F.floor(F.greatest(F.least(scaled, F.lit(float(LIMIT))), F.lit(float(-LIMIT))))

    v = F.transform("embedding", whole)
    if shortest != dimension:
        v = F.concat(v, F.array_repeat(F.lit(0).cast("long"), F.lit(dimension) - F.size("embedding")))
    return kept.select(*carried, v.alias("v")), dimension


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """A column of lists of ``width`` longs as one matrix of a row each."""
    return np.asarray(column.flatten().to_numpy(zero_copy_only=False), np.int64).reshape(len(column), width)


def as_long(values) -> list[int]:
    return [max(min(int(x), LONG), -LONG - 1) for x in values]
