"""Whole vectors as fixed-point integers, for the operators on embeddings."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Larger values have no exact double.
LARGEST = 2.0**53


def usual_length(table: DataFrame, vector_col: str) -> int:
    """The most frequent length of a vector, of equally frequent ones the larger; 0 for a table without any."""
    size = F.size(F.col(f"`{vector_col}`"))
    counts = table.where(size > 0).groupBy(size.alias("n")).agg(F.count("*").alias("rows"))
    found = counts.agg(F.max(F.struct("rows", "n"))).first()[0]
    return 0 if found is None else found["n"]


def fixed_point(column: pa.Array, length: int, scale: int, offset: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """(rows, values): floor(scale * entry) + offset of the vectors that take part, and where they stand.

    A vector takes part if it is not null, has ``length`` entries and none that is null, not finite or without
    an exact double at this scale.
    """
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    ends = np.diff(column.offsets.to_numpy(zero_copy_only=False))
    at = np.flatnonzero(np.asarray(column.is_valid().to_numpy(zero_copy_only=False), dtype=bool) & (ends == length))
    flat = column.take(pa.array(at, pa.int64())).flatten()
    entries = np.asarray(flat.cast(pa.float64()).to_numpy(zero_copy_only=False), dtype=np.float64)  # nulls become NaN
    with np.errstate(all="ignore"):
        values = np.floor(scale * entries.reshape(len(at), length))
        good = (np.abs(values) < LARGEST).all(axis=1)
    return at[good], values[good].astype(np.int64) + offset
