"""Points arriving as a stream of text files.

The reference declares a streaming dependency but runs only bounded jobs.
Nothing new is needed for streams: parsing (S1) and nearest-centroid labelling
(M5) are per-row projections, so the same functions apply to a frame from
``readStream``. Centroids are fixed for the life of the query (they are
constants in its plan); a new centroid set means a new query.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..operators.assign import assign_nearest
from ..sources.text import parse_points


def read_point_stream(spark: SparkSession, path: str, sep: str = " ", max_files_per_trigger: int | None = None) -> DataFrame:
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return parse_points(reader.load(path), sep)


def label_stream(points: DataFrame, centroids, label: str = "cluster_id") -> DataFrame:
    """Label each arriving point with its nearest centroid (SQL form, so the
    stream stays a JVM projection)."""
    return assign_nearest(points, centroids, label=label, engine="sql")
