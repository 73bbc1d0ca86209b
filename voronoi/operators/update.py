"""Centroid update: keyed vector sum + count, then the mean (A1, M7, M8, A3).

All forms aggregate partially inside each task before the shuffle, so a
cluster holding a third of all points costs one buffer per task, not a third
of the rows in one reducer.

* ``update_centroids``: one array row of exact sums for each cluster and task
  (``exact.partials``), a shuffle by cluster, a merge and one division.
* ``vector_mean``: the same for any key, one row per key and position. SQL text
  calls it through ``functions.sql``.
* ``vector_sums``: plain SQL sums for ``engine="sql"``.
* ``integer_mean``: the integer draft, sum ``div`` count (truncation).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.vectors import as_vector
from .exact import merged, partials

# Keep the aggregate buffer under spark.sql.codegen.maxFields (100).
WIDE_AGG_MAX_DIMS = 90


def vector_sums(labelled: DataFrame, d: int, *, label: str = "cluster_id",
                dims: str = "dims") -> DataFrame:
    """A1: (label, n_points, s1..sd) with sums in double."""
    v = F.col(dims)
    if d <= WIDE_AGG_MAX_DIMS:
        return labelled.groupBy(label).agg(
            F.count(F.lit(1)).alias("n_points"),
            *[F.sum(v.getItem(i).cast("double")).alias(f"s{i + 1}") for i in range(d)],
        )
    long = vector_sums_long(labelled, label=label, dims=dims)
    return long.groupBy(label).agg(
        F.first("n_points").alias("n_points"),
        *[F.max(F.when(F.col("pos") == i, F.col("s"))).alias(f"s{i + 1}") for i in range(d)],
    )


def vector_sums_long(labelled: DataFrame, *, label: str = "cluster_id", dims: str = "dims") -> DataFrame:
    """A1 in long form: (label, pos, s, n_points), one row per cluster and position."""
    ex = labelled.select(label, F.posexplode(as_vector(dims)).alias("pos", "x"))
    return ex.groupBy(label, "pos").agg(F.sum("x").alias("s"), F.count(F.lit(1)).alias("n_points"))


def update_centroids(labelled: DataFrame, d: int | None = None, *, label: str = "cluster_id",
                     dims: str = "dims") -> DataFrame:
    """A1 + M7: (label, n_points, dims = per-position mean). Sums are exact
    (``exact.ExactSums``), so the means don't depend on partitions or row order.
    Clusters without points simply have no row (they vanish from the next
    centroid set); NULL is a cluster of its own, as in ``groupBy``. Vectors of another
    length than ``d`` (or than each other), NULL vectors and NULL coordinates raise."""
    return merged(partials(labelled, label, dims, d), label, dims)


def vector_mean(df: DataFrame, *, key: str, dims: str = "dims", d: int | None = None) -> DataFrame:
    """A3, the centroid-average aggregate, as create/add (exact sums of each
    task), merge (shuffle by key) and result (divide), for keys of any
    type. Output: (key, pos, mean, n_points)."""
    means = update_centroids(df, d, label=key, dims=dims)
    return means.select(key, F.posexplode(dims).alias("pos", "mean"), "n_points")


def integer_mean(labelled: DataFrame, d: int, *, label: str, dims: str = "dims") -> DataFrame:
    """M8: per-position ``sum div count`` on integer vectors; ``div`` truncates
    toward zero, as the draft's integer division does."""
    return labelled.groupBy(label).agg(
        F.count(F.lit(1)).alias("n_points"),
        *[F.expr(f"sum(cast(`{dims}`[{i}] as bigint)) div count(1)").alias(f"m{i + 1}") for i in range(d)],
    )
