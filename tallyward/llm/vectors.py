"""Vector columns: which rows hold a usable vector, and Arrow lists as matrices."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAX_DIMENSIONS = 2048  # a square matrix of them (32 MB) is held in the driver


def finite(vector: Column) -> Column:
    """Is the vector there, not empty, and without NULL, NaN and infinite entries?"""
    held = F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))
    return F.coalesce(vector.isNotNull() & (F.size(vector) > 0) & held, F.lit(False))


def dimension(vectors: DataFrame, column: str) -> int:
    """The length most vectors have (the larger of equally frequent ones); 0 where there are none.  Other lengths are no vectors of this table."""
    sizes = vectors.groupBy(F.size(column).alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    if sizes and sizes["d"] > MAX_DIMENSIONS:
        raise ValueError(f"vectors of {sizes['d']} dimensions; at most {MAX_DIMENSIONS} are supported")
    return sizes["d"] if sizes else 0


def matrix(column: pa.Array | pa.ChunkedArray, d: int) -> np.ndarray:
    """Rows of doubles from lists of ``d`` numbers without NULLs."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, d)
