"""What the vector operators share."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def usable(vector: str) -> Column:
    """Not null, not empty, not all zero, and without null or non-finite components."""
    v = F.col(vector)
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(v.isNotNull() & (F.size(v) > 0) & finite & F.exists(v, lambda x: x != 0), F.lit(False))


def common_length(vectors: DataFrame, vector: str) -> int:
    """The commonest length of the usable vectors (of several the smallest); 0 if there are none."""
    row = vectors.groupBy(F.size(vector).alias("d")).count().orderBy(F.desc("count"), "d").first()
    return row["d"] if row else 0


def matrix(column, dim: int) -> np.ndarray:
    """Vectors of a pandas column, in double precision."""
    return np.array([np.asarray(x, np.float64) for x in column]).reshape(-1, dim)


def flat_matrix(column: pa.ChunkedArray, dim: int) -> np.ndarray:
    """Vectors of an Arrow column without nulls, in the column's own precision."""
    parts = [c.flatten().to_numpy(zero_copy_only=False) for c in column.chunks]
    return (np.concatenate(parts) if parts else np.zeros(0)).reshape(-1, dim)
