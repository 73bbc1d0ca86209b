import math

import pytest
from pyspark.sql import functions as F

from voronoi.functions.vectors import (DimensionError, check_dimensions, euclidean_distance, squared_distance,
                                       squared_distance_to, vector_add, vector_scale)


def test_distance_add_scale(spark):
    df = spark.createDataFrame([([1.0, 2.0, 3.0], [4.0, 6.0, 3.0])], "a array<double>, b array<double>")
    r = df.select(squared_distance("a", "b").alias("d2"), euclidean_distance("a", "b").alias("d"),
                  squared_distance_to(F.col("a"), [4.0, 6.0, 3.0]).alias("d2c"),
                  vector_add("a", "b").alias("s"), vector_scale("a", 2).alias("h")).collect()[0]
    assert r.d2 == 25.0 and r.d == 5.0 and r.d2c == 25.0
    assert r.s == [5.0, 8.0, 6.0] and r.h == [0.5, 1.0, 1.5]


def test_dimension_check(spark):
    ok = spark.createDataFrame([([1.0, 2.0],), ([3.0, 4.0],)], "dims array<double>")
    assert check_dimensions(ok) == (2, 2)
    with pytest.raises(DimensionError):
        check_dimensions(ok, expected=3)
    bad = spark.createDataFrame([([1.0, 2.0],), ([3.0],)], "dims array<double>")
    with pytest.raises(DimensionError):
        check_dimensions(bad)
    nulls = spark.createDataFrame([([1.0, None],)], "dims array<double>")
    with pytest.raises(DimensionError):
        check_dimensions(nulls)
    empty = spark.createDataFrame([], "dims array<double>")
    assert check_dimensions(empty) == (0, None)


def test_nan_distance(spark):
    df = spark.createDataFrame([([float("nan")],)], "a array<double>")
    r = df.select(squared_distance_to(F.col("a"), [1.0]).alias("d")).collect()[0]
    assert math.isnan(r.d)
