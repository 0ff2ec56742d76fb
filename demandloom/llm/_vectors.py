"""Embeddings as exact integers, shared by the operators on vectors."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F


def usable(embedding: Column) -> Column:
    """Whether a vector is there and all of its components are numbers."""
    return embedding.isNotNull() & F.forall(embedding, lambda x: F.coalesce(
        F.abs(x) < F.lit(math.inf), F.lit(False)) & ~F.isnan(x))


def largest_component(dims: int) -> int:
    """Up to this size, four times a squared distance fits 64 bits."""
    return math.isqrt((1 << 60) // max(1, dims)) // 2


def integers(column: pa.Array, dims: int, factor: int) -> np.ndarray:
    """``floor(factor * x)`` of every component of a list column, one row per vector.

    Components whose squared distances would not fit 64 bits are an error.
    """
    scaled = np.floor(column.flatten().to_numpy(zero_copy_only=False).astype(np.float64) * factor)
    if scaled.size and np.abs(scaled).max() > largest_component(dims):
        raise OverflowError(f"components above {largest_component(dims) / factor:g} have no exact distance")
    return scaled.astype(np.int64).reshape(-1, dims)


def packed(rows: np.ndarray, kind: str) -> pa.Array:
    """The rows of a matrix as binary values."""
    data = np.ascontiguousarray(rows, dtype=kind)
    width = data.shape[1] * data.itemsize
    ends = np.arange(len(data) + 1, dtype=np.int32) * np.int32(width)
    return pa.Array.from_buffers(pa.binary(), len(data), [None, pa.py_buffer(ends), pa.py_buffer(data)])


def unpacked(column: pa.Array, dims: int, kind: str) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype=kind).reshape(-1, dims)


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact squared distances of the rows of two integer matrices of equal shape."""
    apart = a - b
    return np.einsum("ij,ij->i", apart, apart)


def mean_floor(total: int, count: int) -> int:
    return int(total) // int(count)
