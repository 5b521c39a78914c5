"""Embedding columns as matrices of whole numbers."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SCALE = 256


def _usable(vector: Column) -> Column:
    """Neither null nor empty, and without null, NaN or infinite entries."""
    finite = F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf")))
    return vector.isNotNull() & (F.size(vector) > 0) & finite


def whole_vectors(df: DataFrame, vector: str, *columns: str, scale: int = SCALE) -> tuple[DataFrame, int]:
    """`columns` and `x`, the entries of `vector` times `scale` rounded down, and the number of dimensions.

    Rows whose vector is null, empty, or holds a null or non-finite entry are left out, and so are those with another number
    of dimensions than most rows have (of two that are as frequent, the larger counts). 0 dimensions: there is no vector.
    """
    entries = F.col(vector).cast("array<double>")
    whole = df.filter(_usable(entries)).select(*columns, F.transform(entries, lambda c: F.floor(c * scale)).alias("x"))
    sizes = whole.groupBy(F.size("x").alias("size")).agg(F.count(F.lit(1)).alias("n"))
    most = sizes.orderBy(F.desc("n"), F.desc("size")).first()
    size = most["size"] if most else 0
    return whole.filter(F.size("x") == size), size


def matrix(vectors: pa.Array, size: int) -> np.ndarray:
    """Vectors of `size` entries as rows of 64-bit integers, small enough that their inner products are exact."""
    rows = vectors.flatten().to_numpy(zero_copy_only=False).reshape(len(vectors), size)
    if rows.size and size * max(int(rows.max()), -int(rows.min())) ** 2 >= 1 << 62:
        raise ValueError("components are too large for exact 64-bit inner products")
    return rows


def bytes_column(arrays: list[np.ndarray]) -> pa.Array:
    return pa.array([np.ascontiguousarray(a).tobytes() for a in arrays], pa.binary())
