"""Per-row vector expressions (all JVM-side Column expressions).

Two flavours exist for the distance:

* column-vs-column (``squared_distance(a, b)``) uses the higher-order
  functions ``zip_with`` + ``aggregate``; general but interpreted;
* column-vs-constant (``squared_distance_to(a, v)``) unrolls the sum over the
  known dimensions into plain arithmetic on ``a[i]`` so the whole expression is
  compiled by whole-stage codegen. The assignment hot path uses this one.

Both add the terms left to right starting from the first term, the order of
the sequential loop ``sum += (x_i - y_i)^2``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

DOUBLE_VECTOR = T.ArrayType(T.DoubleType())


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def as_vector(c) -> Column:
    """Any numeric array -> array<double> (float32 embeddings widen exactly)."""
    return _col(c).cast(DOUBLE_VECTOR)


def _bad_vector(kind: str) -> Column:
    """Raise inside the plan (M14); ``kind`` is the type the expression stands in for."""
    return F.raise_error(F.lit("DimensionError: vectors of different lengths, or NULL coordinates")).cast(kind)


def squared_distance(a, b) -> Column:
    """M1: sum_i (a_i - b_i)^2 for two vector columns. Vectors of different
    lengths, NULL vectors and NULL coordinates (all of which give a NULL sum) raise."""
    terms = F.zip_with(_col(a), _col(b), lambda x, y: (x - y) * (x - y))
    return F.coalesce(F.aggregate(terms, F.lit(0.0), lambda acc, t: acc + t), _bad_vector("double"))


def euclidean_distance(a, b) -> Column:
    """M2: sqrt of M1."""
    return F.sqrt(squared_distance(a, b))


def squared_distance_to(a, vector: Sequence[float]) -> Column:
    """M1 against a constant vector, unrolled so it stays inside codegen. Another
    length, a NULL vector and a NULL coordinate raise."""
    a = _col(a)
    total = None
    for i, v in enumerate(vector):
        diff = a.getItem(i) - F.lit(float(v))
        term = diff * diff
        total = term if total is None else total + term
    total = F.lit(0.0) if total is None else total
    return F.coalesce(F.when(F.size(a) == len(vector), total), _bad_vector("double"))


def vector_add(a, b) -> Column:
    """M3: element-wise sum; different lengths, NULL vectors and NULL coordinates raise."""
    total = F.zip_with(_col(a), _col(b), lambda x, y: x + y)
    return F.when(F.coalesce(~F.exists(total, lambda x: x.isNull()), F.lit(False)), total).otherwise(_bad_vector("array<double>"))


def vector_scale(a, n) -> Column:
    """M4: divide every coordinate by a scalar (a count, as in a mean)."""
    n = _col(n) if isinstance(n, (str, Column)) else F.lit(n)
    return F.transform(_col(a), lambda x: x / n)


class DimensionError(ValueError):
    """Vectors of different lengths, or NULL coordinates."""


def dimension_columns(c: str = "dims") -> list[Column]:
    """Aggregates for the length check: rows, min/max length, vectors that are NULL or hold a NULL coordinate."""
    v = F.col(c)
    return [
        F.count(F.lit(1)).alias("n_rows"),
        F.min(F.size(v)).alias("min_dims"),
        F.max(F.size(v)).alias("max_dims"),
        F.sum(F.when(v.isNull() | F.exists(v, lambda x: x.isNull()), 1).otherwise(0)).cast("bigint").alias("n_null"),
    ]


def dimension_summary(df: DataFrame, c: str = "dims") -> DataFrame:
    """One-row aggregate of ``dimension_columns``; nothing but one row reaches the driver."""
    return df.agg(*dimension_columns(c))


def check_dimensions(df: DataFrame, c: str = "dims", expected: int | None = None) -> tuple[int, int | None]:
    """Raise unless every vector has the same length (and ``expected``
    when given). Returns (rows, dims); dims is None for an empty table."""
    return dimensions_of(dimension_summary(df, c).collect()[0].asDict(), c, expected)


def dimensions_of(row: dict, c: str = "dims", expected: int | None = None) -> tuple[int, int | None]:
    """The same from the values of ``dimension_columns``, however they were gathered."""
    n, lo, hi, nulls = row["n_rows"], row["min_dims"], row["max_dims"], row["n_null"]
    if n == 0:
        return 0, expected
    if nulls:
        raise DimensionError(f"{nulls} vectors in '{c}' are NULL or hold NULL coordinates")
    if lo != hi:
        raise DimensionError(f"Vectors in '{c}' have {lo} to {hi} coordinates")
    if expected is not None and lo != expected:
        raise DimensionError(f"Vectors in '{c}' have {lo} coordinates, not {expected}")
    return n, lo
