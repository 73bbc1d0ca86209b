"""A3 in SQL text: the centroid average as table functions.

    SELECT * FROM vector_mean(TABLE(SELECT * FROM vector_partials(TABLE(SELECT label, embedding FROM embeddings))))

``vector_partials`` sums exactly within each task (create + add) and gives out one row for each key it holds;
``vector_mean`` asks Spark to partition these rows by key, merges them (merge) and divides (result). So a key that holds a third of all rows
meets as one row for each task. Keys of any type, NULL among them; the result is that of ``operators.update.update_centroids``.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import SparkSession
from pyspark.sql import types as T
from pyspark.sql.functions import udtf
from pyspark.sql.udtf import AnalyzeArgument, AnalyzeResult, PartitioningColumn

from .vectors import DimensionError
from ..operators.exact import FLUSH_BYTES, NAN_KEY, ExactSum, ExactSums, part_schema, plain_key

#: Rows that a task turns into one matrix.
ROWS = 2048


def _columns(table: AnalyzeArgument, name: str, n: int) -> T.StructType:
    if not table.isTable or not isinstance(table.dataType, T.StructType) or len(table.dataType) != n:
        raise ValueError(f"{name} takes TABLE(...) of {n} columns")
    return table.dataType


class VectorPartials:
    """(key, vector) rows to exact partial sums, in a state that is given out when it has grown to its bound."""

    @staticmethod
    def analyze(table: AnalyzeArgument) -> AnalyzeResult:
        fields = _columns(table, "vector_partials", 2).fields
        if not isinstance(fields[1].dataType, T.ArrayType) or not isinstance(fields[1].dataType.elementType, T.NumericType):
            raise ValueError("vector_partials takes (key, array of numbers)")
        return AnalyzeResult(part_schema(T.StructField("key", fields[0].dataType)))

    def __init__(self):
        self.keys, self.rows, self.sums = [], [], None

    def eval(self, row):
        key, vector = row[0], row[1]
        if vector is None or None in vector:
            raise DimensionError("NULL vector or NULL coordinate in input")
        self.keys.append(key)
        self.rows.append(vector)
        if len(self.rows) >= ROWS:
            self._add()
            if self.sums.nbytes > FLUSH_BYTES:
                yield from self._out()

    def _add(self):
        if self.sums is None:
            self.sums = ExactSums(len(self.rows[0]))
        if any(len(r) != self.sums.d for r in self.rows):
            raise DimensionError(f"Vectors of other lengths than {self.sums.d}")
        places: dict = {}
        index = np.array([places.setdefault(plain_key(k), len(places)) for k in self.keys])
        self.sums.add(list(places), index, np.array(self.rows, np.float64).reshape(len(self.rows), self.sums.d))
        self.keys, self.rows = [], []

    def _out(self):
        for key, n, low, limbs, marks in self.sums.rows():
            yield float("nan") if key is NAN_KEY else key, n, self.sums.d, low, limbs.tolist(), marks
        self.sums.clear()

    def terminate(self):
        if self.rows:
            self._add()
        if self.sums is not None:
            yield from self._out()


class VectorMean:
    """Rows of ``vector_partials``, partitioned by key, to (key, n_points, mean)."""

    @staticmethod
    def analyze(table: AnalyzeArgument) -> AnalyzeResult:
        key = _columns(table, "vector_mean", 6).fields[0]
        schema = T.StructType([T.StructField(key.name, key.dataType), T.StructField("n_points", T.LongType()), T.StructField("mean", T.ArrayType(T.DoubleType()))])
        by = f"`{key.name}`"
        if isinstance(key.dataType, (T.FloatType, T.DoubleType)):
            by = f"CAST({by} AS STRING)"  # a key that is NaN must equal itself
        return AnalyzeResult(schema, partitionBy=[PartitioningColumn(by)])

    def __init__(self):
        self.held, self.key, self.d = None, None, None

    def eval(self, row):
        if self.held is None:
            self.held, self.key, self.d = ExactSum(), row[0], row[2]
        if row[2] != self.d:
            raise DimensionError(f"Vectors of {self.d} and of {row[2]} coordinates")
        self.held.add(row[1], row[3], np.array(row[4], np.int64), row[5], row[2])

    def terminate(self):
        if self.held is not None:
            yield self.key, self.held.n, self.held.mean()


def register(spark: SparkSession) -> None:
    """Makes ``vector_partials`` and ``vector_mean`` known to the session's SQL."""
    spark.udtf.register("vector_partials", udtf(VectorPartials))
    spark.udtf.register("vector_mean", udtf(VectorMean))
