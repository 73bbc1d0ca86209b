"""Gaussian-mixture data generator (S7) and its text sink (K4).

Re-aimed from a single-process file writer to a distributed table generator:
``spark.range(n)`` spreads the points over tasks, and every random number is a
hash of (seed, stream, row, dimension), so the output does not depend on the
number of partitions or on which executor computes a row (``rand``/``randn``
would). No join: a point's centre is recomputed from the same hash.

Semantics kept: k centres uniform in [-range/2, range/2) per dimension; point i
belongs to centre i mod k; each coordinate is centre + N(0, stddev * range);
a *second* uniform draw gives the starting centroids, ids 1..k. The exact
random sequence of the original is not reproduced.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .text import write_lines

# Generator defaults of the reference.
DEFAULT_SEED = 4650285087650871364
DEFAULT_VALUE_RANGE = 100.0
RELATIVE_STDDEV = 0.08
DIMENSIONALITY = 5

_TWO53 = float(1 << 53)


def _uniform(seed: int, stream: str, row: Column, dim: int) -> Column:
    """U[0, 1) from the top 53 bits of xxhash64(seed, stream, row, dim)."""
    h = F.xxhash64(F.lit(seed), F.lit(stream), row, F.lit(dim))
    return F.shiftrightunsigned(h, 11).cast("double") / F.lit(_TWO53)


def _normal(seed: int, row: Column, dim: int) -> Column:
    """Box-Muller from two independent hash uniforms."""
    u1 = F.lit(1.0) - _uniform(seed, "n1", row, dim)  # (0, 1]
    u2 = _uniform(seed, "n2", row, dim)
    return F.sqrt(F.lit(-2.0) * F.log(u1)) * F.cos(F.lit(2 * math.pi) * u2)


def _centre(seed: int, stream: str, cid: Column, dim: int, value_range: float) -> Column:
    return _uniform(seed, stream, cid, dim) * F.lit(value_range) - F.lit(value_range / 2)


def generate_mixture(spark: SparkSession, n_points: int, k: int, *, stddev: float = RELATIVE_STDDEV,
                     value_range: float = DEFAULT_VALUE_RANGE, seed: int = DEFAULT_SEED,
                     dims: int = DIMENSIONALITY, num_partitions: int | None = None) -> tuple[DataFrame, DataFrame]:
    """Returns (points (id, dims), starting centroids (cluster_id 1..k, dims))."""
    if k < 1:
        raise ValueError("k must be at least 1")
    sd = stddev * value_range
    ids = spark.range(0, n_points, numPartitions=num_partitions) if num_partitions else spark.range(0, n_points)
    cid = F.col("id") % F.lit(k)
    coords = [_centre(seed, "mean", cid, j, value_range) + _normal(seed, F.col("id"), j) * F.lit(sd)
              for j in range(dims)]
    points = ids.select(F.col("id"), F.array(*coords).alias("dims"))
    starts = spark.range(0, k, numPartitions=1).select(
        (F.col("id") + 1).alias("cluster_id"),
        F.array(*[_centre(seed, "start", F.col("id"), j, value_range) for j in range(dims)]).alias("dims"))
    return points, starts


def true_means(spark: SparkSession, k: int, *, value_range: float = DEFAULT_VALUE_RANGE,
               seed: int = DEFAULT_SEED, dims: int = DIMENSIONALITY) -> DataFrame:
    """The centres the points were drawn around (cluster i mod k -> id i)."""
    return spark.range(0, k, numPartitions=1).select(
        F.col("id").alias("cluster_id"),
        F.array(*[_centre(seed, "mean", F.col("id"), j, value_range) for j in range(dims)]).alias("dims"))


def two_decimals(dims: Column, sep: str = " ") -> Column:
    """K4: ``#0.00`` (half-even rounding to two places), blank-separated."""
    return F.array_join(F.transform(dims, lambda x: F.format_string("%.2f", F.bround(x, 2))), sep)


def write_generated(points: DataFrame, centers: DataFrame, out_dir: str) -> None:
    """Write ``points`` (``d1 d2 ...``) and ``centers`` (``id d1 d2 ...``)."""
    out = out_dir.rstrip("/")
    write_lines(points.select(two_decimals(F.col("dims")).alias("value")), f"{out}/points")
    write_lines(centers.select(F.concat_ws(" ", F.col("cluster_id").cast("string"),
                                           two_decimals(F.col("dims"))).alias("value")), f"{out}/centers")
