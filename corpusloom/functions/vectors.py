"""Vector arithmetic on ``array<float>`` columns, one NumPy call per Arrow batch.

Spark has no built-in vector functions, and higher-order functions over arrays are interpreted element by element.
Values are widened to double before any arithmetic. A null vector, a vector of another width or a vector without
length has no similarity: the result is null.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, functions as F
from pyspark.sql.functions import arrow_udf

# Similarities are compared at this many digits, which hides rounding noise of differently blocked sums.
RANK_DIGITS = 12


def to_matrix(vectors: pa.Array, width: int) -> np.ndarray:
    """List array to a (rows, width) double matrix; rows that do not fit are NaN."""
    lengths = vectors.value_lengths().fill_null(-1).to_numpy(zero_copy_only=False)
    values = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    fits = lengths == width
    if fits.all():
        return values.reshape(-1, width)
    matrix = np.full((len(vectors), width), np.nan)
    kept = np.repeat(fits, np.maximum(lengths, 0))
    matrix[fits] = values[kept].reshape(-1, width)
    return matrix


def unit_rows(matrix: np.ndarray) -> np.ndarray:
    """Rows scaled to length one; rows of length zero become NaN."""
    norms = np.linalg.norm(matrix, axis=1, keepdims=True)
    norms[norms == 0] = np.nan
    return matrix / norms


def cosine_to(vector: Column | str, query: Sequence[float]) -> Column:
    """Cosine similarity of a vector column to one query vector."""
    goal = np.asarray(query, dtype=np.float64)
    length = np.linalg.norm(goal)
    goal = goal / length if length > 0 else np.full_like(goal, np.nan)

    @arrow_udf("double")
    def similarity(vectors: pa.Array) -> pa.Array:
        return pa.array(unit_rows(to_matrix(vectors, len(goal))) @ goal, pa.float64(), from_pandas=True)

    return similarity(F.col(vector) if isinstance(vector, str) else vector)


def cosine(left: Column | str, right: Column | str) -> Column:
    """Cosine similarity of two vector columns of equal width."""

    @arrow_udf("double")
    def similarity(a: pa.Array, b: pa.Array) -> pa.Array:
        widths = a.value_lengths().drop_null()
        width = widths[0].as_py() if len(widths) else 0
        mixed = len(widths) and (widths.to_numpy() != width).any()
        if not mixed:
            scores = np.einsum("ij,ij->i", unit_rows(to_matrix(a, width)), unit_rows(to_matrix(b, width)))
        else:
            scores = np.array([_pair(x, y) for x, y in zip(a.to_pylist(), b.to_pylist())])
        return pa.array(scores, pa.float64(), from_pandas=True)

    return similarity(*[F.col(c) if isinstance(c, str) else c for c in (left, right)])


def _pair(x: list[float] | None, y: list[float] | None) -> float:
    if x is None or y is None or len(x) != len(y):
        return np.nan
    product = np.linalg.norm(x) * np.linalg.norm(y)
    return float(np.dot(x, y) / product) if product > 0 else np.nan


def nearest_row(vector: Column | str, rows: np.ndarray) -> Column:
    """Index of the row of ``rows`` with the highest cosine similarity (lowest index on a tie)."""
    goals = unit_rows(np.asarray(rows, dtype=np.float64))

    @arrow_udf("int")
    def nearest(vectors: pa.Array) -> pa.Array:
        unit = unit_rows(to_matrix(vectors, goals.shape[1]))
        scores = np.round(unit @ goals.T, RANK_DIGITS)
        missing = np.isnan(unit).any(axis=1)
        best = np.argmax(np.where(np.isnan(scores), -np.inf, scores), axis=1).astype(np.int32)
        return pa.array(best, pa.int32(), mask=missing)

    return nearest(F.col(vector) if isinstance(vector, str) else vector)
