"""What the two vector operators share: which vectors count, bounded samples and matrices from Arrow."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

INFINITE = float("inf")


def usable(vector: Column) -> Column:
    """Not null, finite in every component, and not zero."""
    doubles = vector.cast("array<double>")
    finite = F.forall(doubles, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < INFINITE))
    return F.coalesce(vector.isNotNull() & finite & F.exists(doubles, lambda x: x != 0), F.lit(False))


def matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """Rows of equal length as doubles."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    n = len(column)
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(n, -1) if n else np.empty((0, 0))


def few_rows(batches: Iterator[pa.RecordBatch], most: int = 1000) -> Iterator[pa.RecordBatch]:
    """Smaller batches, where a row is compared with many centroids."""
    for batch in batches:
        for start in range(0, batch.num_rows, most):
            yield batch.slice(start, most)


def by_length(column: pa.Array) -> list[tuple[int, np.ndarray]]:
    """Positions of the rows of each vector length."""
    sizes = pa.compute.list_value_length(column).to_numpy(zero_copy_only=False)
    return [(int(d), np.flatnonzero(sizes == d)) for d in np.unique(sizes)]


def sampled(df: DataFrame, vector: str, most: int, seed: int = 11) -> dict[int, np.ndarray]:
    """At most ``most`` vectors, the first by a seeded hash, as a matrix for each vector length."""
    rows = df.select(vector).orderBy(F.xxhash64(F.lit(seed), vector), vector).limit(most).toArrow().column(0).combine_chunks()
    return {d: matrix(rows.take(pa.array(at))) for d, at in by_length(rows)} if len(rows) else {}


def unit(x: np.ndarray) -> np.ndarray:
    return x / np.linalg.norm(x, axis=1, keepdims=True)
