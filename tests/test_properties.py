import math

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from conftest import SF_SMALL, pts
from voronoi.operators.update import integer_mean, update_centroids, vector_mean
from voronoi.plans.lloyd import kmeans, kmeans_keyed
from voronoi.sources import text
from voronoi.sources.tables import customer_points, first_points

finite = st.floats(allow_nan=False, allow_infinity=False, width=64)


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(-2**31, 2**31 - 1), st.lists(finite, min_size=1, max_size=4)),
                min_size=1, max_size=20))
def test_parse_format_identity(spark, rows):
    d = len(rows[0][1])
    rows = [(i, (v * d)[:d]) for i, v in rows]
    df = spark.createDataFrame(rows, "cluster_id bigint, dims array<double>")
    back = text.parse_centroids(text.format_centroid_lines(df)).collect()
    assert sorted((r.cluster_id, r.dims) for r in back) == sorted(rows)
    keyed = text.parse_keyed(text.format_keyed(df.withColumnRenamed("cluster_id", "id"), cluster_col=None)).collect()
    assert sorted((r.id, r.dims) for r in keyed) == sorted(rows)


def test_integer_mean_truncates(spark):
    df = spark.createDataFrame([("a", [7]), ("a", [8]), ("b", [-7]), ("b", [-8])], "k string, dims array<int>")
    got = {r.k: r.m1 for r in integer_mean(df, 1, label="k").collect()}
    assert got == {"a": 7, "b": -7}


def test_means_agree(spark):
    df = spark.createDataFrame([(1, [1.0, 2.0]), (1, [3.0, 4.0]), (2, [5.0, 6.0])], "cluster_id bigint, dims array<double>")
    a = {r.cluster_id: r.dims for r in update_centroids(df, 2).collect()}
    b = {r.cluster_id: r.dims for r in update_centroids(df).collect()}
    c = {}
    for r in vector_mean(df, key="cluster_id", d=2).collect():
        c.setdefault(r.cluster_id, [0.0, 0.0])[r.pos] = r.mean
    assert a == b == c == {1: [2.0, 3.0], 2: [5.0, 6.0]}


def test_engines_agree_on_customer_loop(spark):
    c = customer_points(spark, SF_SMALL)
    seeds = first_points(c, "c_custkey", 4)
    a = kmeans(c, seeds, keep=["c_custkey"], engine="arrow")
    b = kmeans(c, seeds, keep=["c_custkey"], engine="sql")
    assert a.steps == b.steps and a.centroids.ids.tolist() == b.centroids.ids.tolist()
    assert all(math.isclose(x, y, rel_tol=0, abs_tol=1e-9)
               for x, y in zip(a.centroids.vectors.ravel(), b.centroids.vectors.ravel()))
    la = sorted(map(tuple, a.labels().select("c_custkey", "cluster_id").collect()))
    lb = sorted(map(tuple, b.labels().select("c_custkey", "cluster_id").collect()))
    assert la == lb and len(la) == 150


def test_keyed_equals_plain_when_labels_are_ids(spark):
    p = pts(spark, [(i, [float(i % 7), float(i % 5)]) for i in range(40)], with_id=True)
    seeds = [(100, [0.0, 0.0], 1), (101, [6.0, 4.0], 2), (102, [3.0, 0.0], 3)]
    keyed = kmeans_keyed(p, seeds)
    plain = kmeans(p.select("dims"), [(cl, v) for _, v, cl in seeds], tol=0.0, max_iter=keyed.steps)
    got = {c: v.tolist() for _, v, c in keyed.workset}
    want = {int(i): v.tolist() for i, v in zip(plain.centroids.ids, plain.centroids.vectors)}
    assert got == want
