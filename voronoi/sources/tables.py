"""Point tables derived from the driver's parquet tables.

Each loader reads only the columns it needs (the scan's ReadSchema shows the
pruning) and returns (key, dims array<double>).

* E: embeddings -> (vec_id, embedding widened to double), 64-d.
* C: customer -> (c_custkey, [c_nationkey, c_acctbal / 1000]), 2-d.
* L: lineitem -> [l_quantity, l_extendedprice / 1000, l_discount * 100], 3-d;
  lineitem has no unique key, so it only feeds per-cluster aggregates.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.vectors import as_vector


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def embedding_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "embeddings")
    return e.select(F.col("vec_id"), as_vector("embedding").alias("dims"))


def customer_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    dims = F.array(F.col("c_nationkey").cast("double"), F.col("c_acctbal") / F.lit(1000.0))
    return c.select(F.col("c_custkey"), dims.alias("dims"))


def lineitem_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    dims = F.array(F.col("l_quantity"), F.col("l_extendedprice") / F.lit(1000.0), F.col("l_discount") * F.lit(100.0))
    return li.select(dims.alias("dims"))


def first_points(points: DataFrame, key: str, k: int, id_col: str = "cluster_id") -> DataFrame:
    """Starting centroids: the k points with the smallest keys (a top-k, so a
    bounded sort per task and k rows to the driver), id = the point's key."""
    return points.orderBy(key).limit(k).select(F.col(key).cast("bigint").alias(id_col), "dims")
