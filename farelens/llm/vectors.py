"""Vectors in Arrow batches."""

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def usable(embedding: Column) -> Column:
    """Not null, no null or non-finite component, not zero, not empty."""
    e = embedding.cast("array<double>")
    bad = F.exists(e, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce(~bad & F.exists(e, lambda x: x != 0), F.lit(False))


def by_dimension(batch: pa.RecordBatch, column: str = "embedding"):
    """(dimension, row numbers, matrix of doubles) for each dimension in the batch."""
    lists = batch.column(column)
    sizes = np.diff(lists.offsets.to_numpy())
    flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    starts = np.cumsum(sizes) - sizes
    for size in np.unique(sizes):
        rows = np.flatnonzero(sizes == size)
        yield int(size), rows, flat[starts[rows][:, None] + np.arange(size)]


def matrices(df: DataFrame, column: str = "embedding") -> dict[int, np.ndarray]:
    """A small table of vectors on the driver, a matrix for each dimension."""
    batches = df.select(column).toArrow().to_batches()
    found: dict[int, list] = {}
    for batch in batches:
        for size, _, matrix in by_dimension(batch, column):
            found.setdefault(size, []).append(matrix)
    return {size: np.concatenate(parts) for size, parts in found.items()}
