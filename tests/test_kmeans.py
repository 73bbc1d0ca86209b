import numpy as np
import pytest

from conftest import SF_SMALL, cents, pts
from voronoi.functions.vectors import DimensionError
from voronoi.operators.centroids import CentroidSet
from voronoi.plans.cli import run_kmeans
from voronoi.plans.lloyd import kmeans, kmeans_keyed
from voronoi.sources.defaults import default_centroids, default_points
from voronoi.sources.tables import embedding_points, first_points


def sse(result):
    lab = result.labels(distance="d2")
    return sum(r.d2 for r in lab.collect())


@pytest.mark.parametrize("engine", ["sql", "arrow"])
def test_default_data_golden(spark, engine):
    r = kmeans(default_points(spark), default_centroids(spark), engine=engine)
    assert r.steps == 6 and r.converged
    got = {int(i): np.round(v, 3).tolist() for i, v in zip(r.centroids.ids, r.centroids.vectors)}
    assert got == {1: [-4.904, -45.118], 2: [46.732, -48.337], 3: [26.636, 47.53], 4: [-32.843, 35.964]}
    sizes = sorted(tuple(x) for x in r.labels().groupBy("cluster_id").count().collect())
    assert sizes == [(1, 10), (2, 10), (3, 10), (4, 10)]
    assert abs(sse(r) - 5326.02666) < 1e-4
    r.release()


def test_default_data_one_step(spark):
    r = kmeans(default_points(spark), default_centroids(spark), max_iter=1)
    got = {int(i): np.round(v, 6).tolist() for i, v in zip(r.centroids.ids, r.centroids.vectors)}
    assert got == {1: [-2.276364, -45.901818], 2: [38.614444, -0.743889], 3: [-17.638, 42.396],
                   4: [-37.603333, 34.453333]}
    sizes = dict(tuple(x) for x in r.labels().groupBy("cluster_id").count().collect())
    assert sizes == {1: 15, 2: 9, 3: 9, 4: 7}
    assert abs(sse(r) - 41838.253758) < 1e-5


def test_threshold_zero_and_check_off_run_n_steps(spark):
    assert kmeans(default_points(spark), default_centroids(spark), max_iter=3, tol=0.0).steps == 3
    assert kmeans(default_points(spark), default_centroids(spark), max_iter=3, check=False).steps == 3


def test_empty_cluster_vanishes_and_duplicates_merge(spark):
    p = pts(spark, [[0.0], [1.0], [10.0], [11.0]])
    r = kmeans(p, cents(spark, [(1, [0.0]), (2, [10.0]), (3, [100.0])]))
    assert r.centroids.ids.tolist() == [1, 2]
    r = kmeans(p, cents(spark, [(1, [0.0]), (1, [10.0])]), max_iter=1)
    assert r.centroids.ids.tolist() == [1] and r.centroids.vectors.tolist() == [[5.5]]


def test_no_points_and_no_centroids(spark):
    empty = spark.createDataFrame([], "dims array<double>")
    r = kmeans(empty, cents(spark, [(1, [0.0])]))
    assert r.centroids.k == 0 and r.labels().count() == 0
    p = pts(spark, [[1.0, 2.0], [3.0, 6.0]])
    r = kmeans(p, CentroidSet.of([]))
    assert r.centroids.ids.tolist() == [-1] and r.centroids.vectors.tolist() == [[2.0, 4.0]]
    assert r.steps == 1


def test_length_mismatch_fails_before_step_one(spark):
    with pytest.raises(DimensionError):
        kmeans(pts(spark, [[1.0, 2.0]]), cents(spark, [(1, [0.0, 0.0, 0.0])]))


def test_nan_point_converges(spark):
    r = kmeans(pts(spark, [[float("nan")]]), cents(spark, [(1, [0.0]), (2, [1.0])]))
    assert r.centroids.ids.tolist() == [1] and np.isnan(r.centroids.vectors[0, 0])
    assert r.converged


def test_embeddings_steps_and_properties(spark):
    e = embedding_points(spark, SF_SMALL)
    seeds = first_points(e, "vec_id", 10)
    r = kmeans(e, seeds, keep=["vec_id"])
    assert r.steps == 12
    lab = r.labels(distance="d2").collect()
    assert len(lab) == 500 and len({x.vec_id for x in lab}) == 500
    # every label is the true arg-min against the final centroids
    x = np.array([row.dims for row in lab])
    d = ((x[:, None, :] - r.centroids.vectors[None]) ** 2).sum(-1)
    assert [row.cluster_id for row in lab] == r.centroids.ids[np.argmin(d, 1)].tolist()
    # SSE never rises step over step
    prev = None
    for n in (1, 2, 4, 8):
        s = sse(kmeans(e, seeds, keep=["vec_id"], max_iter=n))
        assert prev is None or s <= prev + 1e-9
        prev = s


def test_partitioning_does_not_change_result(spark):
    e = embedding_points(spark, SF_SMALL)
    seeds = first_points(e, "vec_id", 10)
    base = kmeans(e, seeds, keep=["vec_id"]).centroids
    for n in (1, 4, 16):
        other = kmeans(e.repartition(n), seeds, keep=["vec_id"]).centroids
        assert other.ids.tolist() == base.ids.tolist()
        assert np.allclose(other.vectors, base.vectors, rtol=0, atol=1e-12)


def test_keyed_loop(spark):
    p = pts(spark, [(1, [1.0]), (2, [2.0]), (3, [3.0])], with_id=True)
    r = kmeans_keyed(p, [(4500, [0.0], 1), (4501, [100.0], 2)])
    assert r.steps == 2
    assert [(i, v.tolist(), c) for i, v, c in r.workset] == [(4500, [2.0], 1)]
    assert sorted((x.id, x.cluster_id) for x in r.labels().collect()) == [(1, 1), (2, 1), (3, 1)]


def test_run_kmeans_cli(spark, tmp_path):
    out = str(tmp_path / "result")
    labels, result = run_kmeans(spark, o=out)
    assert result.steps == 6
    lines = [r.value for r in spark.read.text(out).collect()]
    assert len(lines) == 40 and all(line.split("\t")[0] in "1234" for line in lines)
    assert "3\t35.04 50.29" in lines
