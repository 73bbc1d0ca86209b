import math

import pytest
from pyspark.errors import PySparkException
from py4j.protocol import Py4JJavaError

from voronoi.sources import text

ERRORS = (PySparkException, Py4JJavaError, Exception)


def lines(spark, ls):
    return spark.createDataFrame([(x,) for x in ls], "value string")


def parse(spark, ls, sep=" "):
    return [r.dims for r in text.parse_points(lines(spark, ls), sep).collect()]


def test_points_trailing_and_blank(spark):
    assert parse(spark, ["1 2 ", "   ", "3 4"]) == [[1.0, 2.0], [3.0, 4.0]]


@pytest.mark.parametrize("line", ["", " 1 2", "1  2", "1 abc"])
def test_points_errors(spark, line):
    with pytest.raises(ERRORS):
        parse(spark, [line])


def test_java_number_syntax(spark):
    (v,) = parse(spark, ["1.5f NaN Infinity 1d 0x1p3"])
    assert v[0] == 1.5 and math.isnan(v[1]) and v[2] == math.inf and v[3] == 1.0 and v[4] == 8.0


def test_literal_separator(spark):
    assert parse(spark, ["1|2|"], sep="|") == [[1.0, 2.0]]
    assert parse(spark, ["1.5,2"], sep=",") == [[1.5, 2.0]]


def test_centroids(spark):
    r = text.parse_centroids(lines(spark, ["7 1 2", "8", "  "])).collect()
    assert [(x.cluster_id, x.dims) for x in r] == [(7, [1.0, 2.0]), (8, [])]
    with pytest.raises(ERRORS):
        text.parse_centroids(lines(spark, ["7.0 1"])).collect()


def test_keyed(spark):
    df = lines(spark, ["1,2 3", "9,2 3,4", "1,2 3,4,5"])
    r = sorted((x.id, x.dims, x.cluster_id) for x in text.parse_keyed(df).collect())
    assert r == [(1, [2.0, 3.0], -1), (9, [2.0, 3.0], 4)]
    assert text.keyed_rejects(df).count() == 1
    with pytest.raises(ERRORS):
        text.parse_keyed(lines(spark, ["1"])).collect()


def test_int_points(spark):
    r = text.parse_int_points(lines(spark, ["7 8", "-7 -8"])).collect()
    assert [x.dims for x in r] == [[7, 8], [-7, -8]]


def test_format_roundtrip(spark):
    df = spark.createDataFrame([(3, [-14.22, 1.0e7, 0.5])], "cluster_id bigint, dims array<double>")
    (lab,) = [r.value for r in text.format_labelled(df).collect()]
    assert lab == "3\t-14.22 1.0E7 0.5"
    c = text.format_centroid_lines(df).collect()[0].value
    assert c == "3 -14.22 1.0E7 0.5"
    back = text.parse_centroids(lines(spark, [c])).collect()[0]
    assert back.cluster_id == 3 and back.dims == [-14.22, 1.0e7, 0.5]
    k = text.format_keyed(df.withColumnRenamed("cluster_id", "id").selectExpr("id", "dims", "7 as cluster_id"))
    kb = text.parse_keyed(k).collect()[0]
    assert (kb.id, kb.dims, kb.cluster_id) == (3, [-14.22, 1.0e7, 0.5], 7)


def test_write_read_files(spark, tmp_path):
    df = spark.createDataFrame([(1, [1.5, 2.0]), (2, [3.0, -4.0])], "cluster_id bigint, dims array<double>")
    out = str(tmp_path / "labelled")
    text.write_labelled(df, out)
    got = sorted(r.value for r in spark.read.text(out).collect())
    assert got == ["1\t1.5 2.0", "2\t3.0 -4.0"]
    p = str(tmp_path / "pts")
    text.write_lines(text.format_point_lines(df), p)
    assert sorted(r.dims for r in text.read_points(spark, p).collect()) == [[1.5, 2.0], [3.0, -4.0]]


def test_fixed_width_parse(spark):
    r = text.parse_points(lines(spark, ["1 2 ", "   ", "3 4"]), d=2).collect()
    assert [x.dims for x in r] == [[1.0, 2.0], [3.0, 4.0]]
    with pytest.raises(ERRORS):
        text.parse_points(lines(spark, ["1 2 3"]), d=2).collect()
    assert [x.dims for x in text.parse_int_points(lines(spark, ["7 8"]), d=2).collect()] == [[7, 8]]
