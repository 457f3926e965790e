"""Vectors of whole numbers: validation and scaling in Spark, matrices in numpy.

Every component x becomes floor(scale * x), x as double. This is exact: the floor of a float is a float. Rows whose key,
vector or any component is null, and rows with NaN or an infinite component, are left out.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

#: Whole numbers below this are exact in double arithmetic.
EXACT = 1 << 53


def whole_vectors(table: DataFrame, key: str, vector: str, scale: int, more: dict[str, Column] | None = None) -> DataFrame:
    """``key`` (long), ``vector`` and the columns ``more`` of the rows that take part."""
    kind = table.schema[vector].dataType.elementType.typeName()
    exact = "float" if kind == "float" else "double"
    scaled = lambda x: F.lit(float(scale)) * x.cast("double")
    whole = lambda x: F.when(F.abs(scaled(x)) < float(1 << 52), F.floor(scaled(x)).cast("double")).otherwise(scaled(x)).cast(exact)
    broken = F.exists("vector", lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == float("inf")))
    rows = table.select(table[key].cast("long").alias("key"), table[vector].alias("vector"), *[c.alias(name) for name, c in (more or {}).items()])
    rows = rows.where(F.col("key").isNotNull() & F.col("vector").isNotNull()).where(~broken)
    return rows.withColumn("vector", F.transform("vector", whole))


def matrices(column: pa.ChunkedArray) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """For each length of vectors: which rows have it, and these rows as a matrix of doubles."""
    lists = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], column.type)
    size = pc.list_value_length(lists).to_numpy(zero_copy_only=False)
    out = {}
    for length in np.unique(size):
        at = np.flatnonzero(size == length)
        own = lists if len(at) == len(lists) else lists.take(pa.array(at))
        out[int(length)] = at, own.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(at), int(length))
    return out


def as_integers(matrix: np.ndarray) -> np.ndarray:
    """The same whole numbers as int64, or as Python integers where these may not hold their products."""
    if matrix.size == 0 or np.abs(matrix).max() < 1 << 62:
        return matrix.astype(np.int64)
    return np.frompyfunc(int, 1, 1)(matrix)


def exact_scores(one: np.ndarray, other: np.ndarray) -> np.ndarray:
    """All inner products as Python integers, whatever the components."""
    return np.frompyfunc(int, 1, 1)(one) @ np.frompyfunc(int, 1, 1)(other).T if one.shape[1] else np.zeros((len(one), len(other)), object)


def as_longs(scores: np.ndarray) -> np.ndarray:
    """Scores as int64; an error if one does not fit."""
    if scores.dtype == object and len(scores) and max(abs(int(scores.max())), abs(int(scores.min()))) >= 1 << 63:
        raise OverflowError("an inner product does not fit a long")
    return scores.astype(np.int64)
