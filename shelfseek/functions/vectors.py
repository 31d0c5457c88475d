"""Vector checks and dot products."""

from __future__ import annotations

import json
import math
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

# Rows multiplied at once inside a task: 1024 x 1536 doubles are 12 MB.
ROWS_PER_SLICE = 1024


def vector_enforce(vector: Column, dims: int, element: str = "float") -> Column:
    """``vector`` as ``array<element>`` if it has ``dims`` numbers, none of them NULL or NaN, else NULL."""
    typed = vector.try_cast(f"array<{element}>")
    whole = (F.size(typed) == dims) & ~F.exists(typed, lambda x: x.isNull() | F.isnan(x))
    return F.when(whole, typed)


def vector_parameter(value: Sequence[float] | str, dims: int | None = None) -> list[float]:
    """A query vector as a list of floats, from a sequence or its JSON text."""
    items = json.loads(value) if isinstance(value, str) else value
    if not isinstance(items, (list, tuple, np.ndarray)):
        raise ValueError("embedding must be an array of numbers")
    vector = [float(np.float32(x)) for x in items]
    if not vector or not all(math.isfinite(x) for x in vector):
        raise ValueError("embedding must hold finite numbers")
    if dims is not None and len(vector) != dims:
        raise ValueError(f"embedding has {len(vector)} numbers, expected {dims}")
    return vector


def dense_rows(vectors: pa.Array, dims: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the usable vectors of a list array, and those vectors as one matrix.

    Unusable are NULL, of another length, or holding a NULL.
    """
    usable = pc.fill_null(pc.equal(pc.list_value_length(vectors), dims), False)
    if vectors.flatten().null_count:
        holed = pc.list_parent_indices(vectors).filter(pc.is_null(vectors.flatten()))
        flags = usable.to_numpy(zero_copy_only=False).copy()
        flags[holed.to_numpy(zero_copy_only=False)] = False
        usable = pa.array(flags)
    positions = np.flatnonzero(usable.to_numpy(zero_copy_only=False))
    values = vectors.filter(usable).flatten().to_numpy(zero_copy_only=False)
    return positions, values.reshape(len(positions), dims)


def ordered_dot(matrix: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Row-wise dot products in double, summed left to right so that every engine agrees."""
    out = np.empty(len(matrix))
    for start in range(0, len(matrix), ROWS_PER_SLICE):
        rows = matrix[start : start + ROWS_PER_SLICE]
        out[start : start + ROWS_PER_SLICE] = np.cumsum(rows * query, axis=1)[:, -1]
    return out


def dot_product(vector: Column, query: Sequence[float]) -> Column:
    """Dot product of a vector column with one query vector; NULL where lengths differ.

    Arrow batches are about twice as fast as ``aggregate(zip_with(...))``, which Spark interprets
    """
    q = np.asarray(query, dtype=np.float64)

    @F.arrow_udf("double")
    def scores(batch: pa.Array) -> pa.Array:
        positions, matrix = dense_rows(batch, len(q))
        out = np.zeros(len(batch))
        missing = np.ones(len(batch), dtype=bool)
        out[positions] = ordered_dot(matrix, q)
        missing[positions] = False
        return pa.array(out, mask=missing)

    return scores(vector)


def dot_product_pairs(left: Column, right: Column) -> Column:
    """Row-wise dot product of two columns of equally long vectors, in Arrow batches; NULL where a side is unusable."""

    @F.arrow_udf("double")
    def scores(one: pa.Array, other: pa.Array) -> pa.Array:
        lengths = [n for n in pc.unique(pc.list_value_length(other)).to_pylist() if n]
        out = np.zeros(len(one))
        missing = np.ones(len(one), dtype=bool)
        for dims in lengths:
            at, a = dense_rows(one, dims)
            to, b = dense_rows(other, dims)
            both, i, j = np.intersect1d(at, to, assume_unique=True, return_indices=True)
            out[both] = np.cumsum(a[i].astype(np.float64) * b[j], axis=1)[:, -1]
            missing[both] = False
        return pa.array(out, mask=missing)

    return scores(left, right)


def same_length(vector: Column, query: Sequence[float]) -> Column:
    """``vector``, or an error if it has another number of numbers than ``query``."""
    message = F.concat(F.lit(f"embedding has {len(query)} numbers, the collection's have "), F.size(vector))
    return F.when(F.size(vector) != len(query), F.raise_error(message).cast("array<float>")).otherwise(vector)


def dot_product_columns(left: Column, right: Column) -> Column:
    """Dot product of two vector columns; NULL where lengths differ or a side is NULL."""
    products = F.zip_with(left, right, lambda x, y: x.cast("double") * y.cast("double"))
    total = F.aggregate(products, F.lit(0.0), lambda a, x: a + x)
    return F.when(F.size(left) == F.size(right), total)
