"""Embedding tables: the rows that are whole, and Arrow lists as numpy arrays."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def whole_vectors(rows: DataFrame, vector: str = "embedding", **keep: Column) -> DataFrame:
    """``keep`` and ``x`` (array<double>) of the rows whose vector is not null and has finite entries only."""
    x = F.col(f"`{vector}`").cast("array<double>")
    kept = rows.select(*(c.alias(n) for n, c in keep.items()), x.alias("x")).filter("x is not null")
    broken = lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf"))
    return kept.filter(~F.exists("x", broken))


def matrix(column: pa.Array, dim: int) -> np.ndarray:
    """A column of lists of one length as rows of an array."""
    if (column.value_lengths().to_numpy(zero_copy_only=False) != dim).any():
        raise ValueError(f"vectors differ in length: {dim} and others")
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), dim)


def whole_numbers(x: np.ndarray, times: int, plus: int, limit: int) -> np.ndarray:
    """floor(times * x) + plus as 64-bit integers; beyond ``limit`` an error."""
    y = np.floor(x * times)
    if y.size and np.abs(y).max() >= limit:
        raise ValueError(f"a component is too large for exact integers: beyond {limit} after scaling")
    return y.astype(np.int64) + plus


def lists(rows: np.ndarray) -> pa.Array:
    """The rows of an array as a column of lists."""
    n, width = rows.shape
    return pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * width), pa.array(rows.ravel()))
