"""Vectors of whole numbers: quantising, exact inner products, blocks of rows as bytes."""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

#: Doubles up to this size hold every whole number.
EXACT = 2.0**53
_LARGEST = sys.float_info.max
#: Stands for a null id in arrays, so that such a row comes last in ties.
NO_ID = np.iinfo(np.int64).max


def sound(vector: str | Column) -> Column:
    """Whether a vector is there and all its components are finite numbers."""
    vector = F.col(vector) if isinstance(vector, str) else vector
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < F.lit(float("inf"))))
    return vector.isNotNull() & finite


def floored(vector: str | Column, scale: int) -> Column:
    """Floor of each component times ``scale``, as doubles. From 2^53 on every double is whole; no product leaves the doubles."""
    vector = F.col(vector) if isinstance(vector, str) else vector

    def whole(x: Column) -> Column:
        scaled = x.cast("double") * F.lit(float(scale))
        held = F.greatest(F.lit(-_LARGEST), F.least(F.lit(_LARGEST), scaled))
        return F.when(F.abs(held) < F.lit(EXACT), F.floor(held).cast("double")).otherwise(held)

    return F.transform(vector, whole)


def inner_products(queries: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Exact inner products as 64-bit integers; one beyond them is given as the nearest they hold."""
    n_parts = queries.shape[1]
    most = float(np.abs(queries).max(initial=0.0)), float(np.abs(rows).max(initial=0.0))
    with np.errstate(over="ignore"):
        bound = most[0] * most[1] * n_parts
    if bound < EXACT:
        return (queries @ rows.T).astype(np.int64)
    if bound < 2.0**62:
        return queries.astype(np.int64) @ rows.astype(np.int64).T
    exact = _python_ints(queries) @ _python_ints(rows).T
    limits = np.iinfo(np.int64)
    return np.array([[min(max(x, limits.min), limits.max) for x in row] for row in exact.tolist()], np.int64).reshape(exact.shape)


def _python_ints(values: np.ndarray) -> np.ndarray:
    whole = np.empty(values.shape, object)
    whole.ravel()[:] = [int(x) for x in values.ravel().tolist()]
    return whole


def matrix(vectors: pa.ListArray | pa.ChunkedArray, length: int) -> np.ndarray:
    """Vectors of one length as the rows of a matrix."""
    if isinstance(vectors, pa.ChunkedArray):
        vectors = vectors.combine_chunks()
    return vectors.flatten().to_numpy(zero_copy_only=False).reshape(len(vectors), length)


def ids_of(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.fill_null(NO_ID).to_numpy(zero_copy_only=False)


def given_id(name: str) -> Column:
    """The id that an array's number stands for."""
    return F.when(F.col(name) != F.lit(int(NO_ID)), F.col(name)).alias(name)


def spread(rows: DataFrame, *columns: str, copies: int = 1 << 30) -> Column:
    """A number by which repeats of one row part: its hash and a random draw of fixed seed."""
    return F.xxhash64(*columns, (F.rand(17) * copies).cast("long"))
