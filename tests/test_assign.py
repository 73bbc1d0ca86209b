import numpy as np
import pytest

from conftest import SF_SMALL, cents, pts
from voronoi.operators import centroids as centroids_mod
from voronoi.operators.assign import assign_by_min, assign_nearest, distance_matrix
from voronoi.operators.centroids import CentroidSet
from voronoi.sources.tables import embedding_points, first_points


@pytest.mark.parametrize("engine", ["sql", "arrow"])
def test_tie_goes_to_lowest_id(spark, engine):
    p = pts(spark, [[0.0]])
    c = cents(spark, [(2, [1.0]), (1, [-1.0])])
    assert assign_nearest(p, c, engine=engine).collect()[0].cluster_id == 1


@pytest.mark.parametrize("engine", ["sql", "arrow"])
def test_nan_point_and_no_centroids(spark, engine):
    p = pts(spark, [[float("nan")], [0.4]])
    c = cents(spark, [(1, [0.0]), (2, [1.0])])
    got = sorted(r.cluster_id for r in assign_nearest(p, c, engine=engine).collect())
    assert got == [1, 1]
    none = assign_nearest(p, CentroidSet.of([]), engine=engine).collect()
    assert [r.cluster_id for r in none] == [-1, -1]


def test_nan_centroid_loses(spark):
    p = pts(spark, [[0.0]])
    c = cents(spark, [(1, [float("nan")]), (2, [5.0])])
    for engine in ("sql", "arrow"):
        assert assign_nearest(p, c, engine=engine).collect()[0].cluster_id == 2



@pytest.mark.parametrize("size", [2, 300])
@pytest.mark.parametrize("engine", ["auto", "sql", "arrow"])
@pytest.mark.parametrize("bad", [[1.0], [1.0, 2.0, 3.0], [1.0, None], None])
def test_bad_vectors_raise_at_every_size(spark, size, engine, bad):
    p = spark.createDataFrame([(1, [0.0, 0.0]), (2, bad)], "id bigint, dims array<double>")
    cs = CentroidSet.of([(j, [float(j), 0.0]) for j in range(size)])
    for made in (assign_nearest(p, cs, engine=engine), distance_matrix(p, cs, engine=engine)):
        with pytest.raises(Exception, match="DimensionError|coordinates|NULL vector|INVALID_ARRAY_INDEX"):
            made.collect()


def test_sql_is_obeyed_or_refused(spark):
    p = spark.createDataFrame([(1, [0.0, 0.0])], "id bigint, dims array<double>")
    with pytest.raises(ValueError):
        assign_nearest(p, CentroidSet.of([(j, [float(j), 0.0]) for j in range(3000)]), engine="sql")


def test_keep_leaves_the_vector_out(spark):
    p = spark.createDataFrame([(1, [0.0, 0.0]), (2, [9.0, 0.0])], "id bigint, dims array<double>")
    cs = CentroidSet.of([(0, [0.0, 0.0]), (1, [8.0, 0.0])])
    for engine in ("sql", "arrow"):
        got = assign_nearest(p, cs, engine=engine, keep=["id"])
        assert got.columns == ["id", "cluster_id"]
        assert sorted(map(tuple, got.collect())) == [(1, 0), (2, 1)]


def _brute(x, ids, vecs):
    d = ((x[:, None, :] - vecs[None, :, :]) ** 2).sum(-1)
    return ids[np.argmin(d, axis=1)]


def test_engines_agree_with_brute_force(spark):
    e = embedding_points(spark, SF_SMALL)
    seeds = first_points(e, "vec_id", 10)
    cs = CentroidSet.from_frame(seeds)
    rows = e.orderBy("vec_id").collect()
    x = np.array([r.dims for r in rows])
    want = dict(zip([r.vec_id for r in rows], _brute(x, cs.ids, cs.vectors)))
    for engine in ("sql", "arrow"):
        got = {r.vec_id: r.cluster_id for r in assign_nearest(e, cs, engine=engine).collect()}
        assert got == want, engine


def test_blocked_broadcast(spark, monkeypatch):
    """Centroid sets above one broadcast block are scanned block by block."""
    monkeypatch.setattr(centroids_mod, "BROADCAST_BLOCK_BYTES", 64 * 8 * 3)
    e = embedding_points(spark, SF_SMALL)
    cs = CentroidSet.from_frame(first_points(e, "vec_id", 10))
    assert len(cs.shipped(spark)) == 4
    a = {r.vec_id: r.cluster_id for r in assign_nearest(e, cs, engine="arrow").collect()}
    b = {r.vec_id: r.cluster_id for r in assign_nearest(e, cs, engine="sql").collect()}
    assert a == b


def test_distance_matrix_and_argmin(spark):
    p = pts(spark, [(1, [0.0, 0.0]), (2, [3.0, 4.0])], with_id=True)
    c = cents(spark, [(1, [0.0, 0.0]), (2, [3.0, 0.0])])
    m = distance_matrix(p, c)
    assert sorted((r.id, r.cluster_id, r.distance) for r in m.collect()) == [
        (1, 1, 0.0), (1, 2, 3.0), (2, 1, 5.0), (2, 2, 4.0)]
    best = sorted((r.id, r.cluster_id) for r in assign_by_min(m).collect())
    assert best == [(1, 1), (2, 2)]


def test_keyed_label(spark):
    p = pts(spark, [(1, [1.0]), (2, [90.0])], with_id=True)
    cs = CentroidSet.of([(4500, [0.0]), (4501, [100.0])], labels=[1, 2])
    got = sorted((r.id, r.cluster_id) for r in assign_nearest(p, cs).collect())
    assert got == [(1, 1), (2, 2)]
