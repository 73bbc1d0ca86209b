"""Session helpers: build a local session for tests/bench, and find the
shared checkpoint folder the cluster names in ``spark.checkpoint.dir``."""

from __future__ import annotations

from pyspark.sql import SparkSession


def local_session(cores: str | int = "*", shuffle_partitions: int = 8,
                  app: str = "voronoi") -> SparkSession:
    """A local session for tests and the bench (never used on a cluster,
    where the caller brings its own session)."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark
