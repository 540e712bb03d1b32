"""Which rows of a table hold a vector that can be used."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def as_vector(column: str) -> Column:
    return F.col(f"`{column}`").cast("array<double>")


def is_finite(vector: Column) -> Column:
    """Whether a vector is there, has entries, and all of them are finite numbers."""
    fine = F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    return F.coalesce(vector.isNotNull() & (F.size(vector) > 0) & fine, F.lit(False))


def common_length(vectors: DataFrame, column: str) -> int:
    """The length most of the vectors have, of equally frequent ones the smallest; 0 if there are none."""
    lengths = vectors.groupBy(F.size(F.col(column)).alias("length")).count()
    most = lengths.orderBy(F.desc("count"), "length").first()
    return most["length"] if most else 0


def matrix(lists: pa.Array, length: int) -> np.ndarray:
    """Rows of equal length as one array."""
    flat = lists.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(lists), length)
