"""Order-free sums, the certified kernel, streamed blocks, the keyed state, table functions and the keyed job."""

import datetime
import math
import resource
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import SF_SMALL, pts
from voronoi import catalog
from voronoi.functions import sql
from voronoi.functions.vectors import DimensionError
from voronoi.operators import assign, centroids, exact
from voronoi.operators.assign import assign_by_min, assign_nearest, distance_matrix
from voronoi.operators.centroids import CentroidSet
from voronoi.operators.exact import ExactSum, ExactSums
from voronoi.operators.nearest import Nearest, nearest, streamed
from voronoi.operators.update import update_centroids, vector_mean
from voronoi.plans.cli import run_kmeans_keyed
from voronoi.plans.lloyd import kmeans, kmeans_keyed
from voronoi.sources.tables import customer_points, embedding_points, first_points

doubles = st.floats(allow_nan=False, allow_infinity=False, width=64)


def total(rows, d, order, cuts):
    """The merged sum of rows, given in an order and split between so many accumulators."""
    held = ExactSum()
    for part in np.array_split(order, cuts):
        sums = ExactSums(d)
        sums.add(["k"], np.zeros(len(part), np.int64), rows[part])
        for _, n, low, limbs, marks in sums.rows():
            held.add(n, low, limbs, marks, d)
    return held


@settings(max_examples=150, deadline=None)
@given(st.lists(st.tuples(doubles, doubles), min_size=1, max_size=30), st.integers(1, 5), st.randoms())
def test_sums_are_exact_in_every_order(values, cuts, rng):
    rows = np.array(values, np.float64)
    order = list(range(len(rows)))
    rng.shuffle(order)
    got = total(rows, 2, np.array(order), cuts).mean()
    for i in range(2):
        want = sum(Fraction(v[i]) for v in values) / len(values)
        try:
            assert got[i] == float(want)
        except OverflowError:
            assert math.isinf(got[i])


def test_special_values_and_taking_away():
    rows = np.array([[1.0, np.inf, np.nan, np.inf], [2.0, 1.0, 0.0, -np.inf]])
    got = total(rows, 4, np.arange(2), 2).mean()
    assert got[0] == 1.5 and got[1] == math.inf and math.isnan(got[2]) and math.isnan(got[3])
    sums = ExactSums(1)
    x = np.array([[0.1], [0.2], [1e300], [5e-324]])
    sums.add(["a"], np.zeros(4, int), x)
    sums.add(["a"], np.zeros(3, int), x[1:], -1)
    (_, n, low, limbs, marks), = sums.rows()
    held = ExactSum()
    held.add(n, low, limbs, marks, 1)
    assert n == 1 and held.mean() == [0.1]


def test_centroids_are_the_same_for_every_partitioning(spark):
    """Bit for bit, on values whose double sums depend on their order."""
    c = customer_points(spark, "/root/testdata/sf0.01").select("c_custkey", F.transform("dims", lambda x: x / 3).alias("dims"))
    seeds = CentroidSet.from_few(first_points(c, "c_custkey", 4), 4)
    runs = [kmeans(c.repartition(n), seeds, keep=["c_custkey"], max_iter=6) for n in (1, 7, 32)]
    assert len({r.centroids.vectors.tobytes() for r in runs}) == 1 and len({r.steps for r in runs}) == 1
    keyed = [kmeans_keyed(c.repartition(n).withColumnRenamed("c_custkey", "id"), CentroidSet(seeds.ids, seeds.vectors, seeds.ids)) for n in (1, 7, 32)]
    assert len({b"".join(v.tobytes() for _, v, _ in r.workset) for r in keyed}) == 1 and len({r.steps for r in keyed}) == 1


@pytest.mark.parametrize("limit", [0, 8 << 20])
def test_merge_by_spark_or_driver(spark, monkeypatch, limit):
    e = embedding_points(spark, SF_SMALL)
    seeds = CentroidSet.from_few(first_points(e, "vec_id", 10), 10)
    want = kmeans(e.repartition(3), seeds, keep=["vec_id"], max_iter=4).centroids
    monkeypatch.setattr(exact, "DRIVER_BYTES", limit)
    got = kmeans(e.repartition(5), seeds, keep=["vec_id"], max_iter=4).centroids
    assert got.vectors.tobytes() == want.vectors.tobytes()


def test_flush_keeps_the_result(spark, monkeypatch):
    e = embedding_points(spark, SF_SMALL).select((F.col("vec_id") % 37).alias("g"), "dims")
    want = sorted(map(tuple, update_centroids(e, label="g").collect()))
    monkeypatch.setattr(exact, "FLUSH_BYTES", 1)
    assert sorted(map(tuple, update_centroids(e.repartition(3), label="g").collect())) == want


KINDS = ["plain", "integers", "offset", "odd", "wide"]


@pytest.mark.parametrize("kind", KINDS)
def test_kernel_is_the_sequential_one(kind):
    """Labels and distances to the last bit, over blocks, with ties, NaN and infinities; the bound never exceeds the truth."""
    rng = np.random.default_rng(KINDS.index(kind))
    with np.errstate(all="ignore"):
        for _ in range(60):
            n, k, d = int(rng.integers(1, 60)), int(rng.integers(1, 40)), int(rng.integers(0, 9))
            x, c = rng.normal(size=(n, d)), rng.normal(size=(k, d))
            if kind == "integers":
                x, c = np.round(2 * x), np.round(2 * c)
            if kind == "offset":
                x, c = x * 1e-3 + 1e6, c * 1e-3 + 1e6
            if kind == "odd":
                x[rng.random((n, d)) < 0.1] = np.nan
                c[rng.random((k, d)) < 0.05] = np.inf
            if kind == "wide":
                x, c = x * 10.0 ** rng.integers(-200, 200, (n, 1)), c * 10.0 ** rng.integers(-200, 200, (k, 1))
            cut = int(rng.integers(0, k + 1))
            found = Nearest(x, second=True)
            for at, block in ((0, c[:cut]), (cut, c[cut:])):
                found.block(at, block)
            index, distance = nearest(np.ascontiguousarray(x.T), [(0, c)])
            assert (found.index == index).all() and np.array_equal(found.distance, distance, equal_nan=True)
            dist = np.zeros((n, k))
            for i in range(d):
                dist = dist + (x[:, i, None] - c[None, :, i]) ** 2
            low = np.where(np.isnan(dist), np.inf, dist)
            assert (index == np.argmin(low, axis=1)).all() or d == 0
            if kind in KINDS[:3] and d:
                low[np.arange(n), index] = np.inf
                assert (found.beyond() <= np.sqrt(low.min(axis=1)) * (1 + 1e-12) + 1e-12).all()


def test_blocks_are_dropped(spark, monkeypatch):
    """A worker holds one broadcast block at a time: four blocks take no more memory than one does and a half."""
    monkeypatch.setattr(centroids, "BROADCAST_BLOCK_BYTES", 32 << 20)
    monkeypatch.setattr(centroids, "CLOSURE_MAX_BYTES", 0)

    def grown(k):
        cs = CentroidSet.from_arrays(np.arange(k), np.random.default_rng(1).normal(size=(k, 64)))
        blocks = cs.shipped(spark)

        def run(batches):
            for b in batches:
                base = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
                rows, held = 0, 0
                for _ in range(2):
                    for _, c in streamed(blocks):
                        rows += len(c)
                        held = max(held, sum("_value" in vars(h) for _, h in blocks))
                yield pa.RecordBatch.from_arrays([pa.array([resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - base]), pa.array([rows]), pa.array([held])], names=["kb", "rows", "held"])

        return len(blocks), spark.range(1).coalesce(1).mapInArrow(run, "kb long, rows long, held long").collect()[0]

    n, four = grown(4 * 65536)
    assert n == 4 and four.rows == 8 * 65536 and four.held == 1
    assert four.kb < 3 * (32 << 10)  # a block, and its pickled form while it is read; four would be 128 MB


def test_arrow_and_blocks_agree(spark, monkeypatch):
    e = embedding_points(spark, SF_SMALL)
    cs = CentroidSet.from_few(first_points(e, "vec_id", 40), 40)
    want = sorted(map(tuple, assign_nearest(e, cs, distance="d2", keep=["vec_id"], engine="arrow").collect()))
    monkeypatch.setattr(centroids, "BROADCAST_BLOCK_BYTES", 64 * 8 * 7)
    monkeypatch.setattr(centroids, "CLOSURE_MAX_BYTES", 0)
    assert sorted(map(tuple, assign_nearest(e, cs, distance="d2", keep=["vec_id"], engine="arrow").collect())) == want
    monkeypatch.setattr(assign, "MATRIX_ROWS", 5)
    m = distance_matrix(e, cs, keep=("vec_id",), euclidean=False)
    assert m.count() == 500 * 40
    assert sorted((r.vec_id, r.cluster_id) for r in assign_by_min(m, key="vec_id").collect()) == [w[:2] for w in want]


def test_candidates_are_reduced_before_the_exchange(spark, monkeypatch):
    rows = [(k, None if k == 3 and c == 2 else float("nan") if k == 4 and c else float(((k or 5) * c) % 5), c) for k in [1, 2, 3, 4, None] * 3 for c in range(6)]
    df = spark.createDataFrame([(str(k) if k else None, d, c) for k, d, c in rows], "id string, distance double, cluster_id long")
    plain = df.groupBy("id").agg(F.min(F.struct("distance", "cluster_id")).alias("m")).select("id", "m.cluster_id")
    for held in (1 << 17, 3):
        monkeypatch.setattr(assign, "HELD_MINIMA", held)
        assert sorted(map(str, assign_by_min(df).collect())) == sorted(map(str, plain.collect()))
    local = df.coalesce(1).select("id", "distance", "cluster_id").mapInArrow(assign._local_minima, "k string, d double, l long")
    monkeypatch.setattr(assign, "HELD_MINIMA", 1 << 17)
    assert df.coalesce(1).mapInArrow(assign._local_minima, "k string, d double, l long").count() == 5 <= local.count()


def test_keyed_loop_visits_fewer_points(spark):
    rng = np.random.default_rng(7)
    x = np.concatenate([rng.normal(c, 1.2, size=(300, 3)) for c in ((0, 0, 0), (6, 0, 0), (0, 6, 0), (6, 6, 3))])
    p = pts(spark, [(i, v.tolist()) for i, v in enumerate(x)], with_id=True)
    seeds = [(10 + i, x[i * 7].tolist(), i % 4) for i in range(4)] + [(20, [500.0, 0.0, 0.0], 9), (21, x[900].tolist(), 2)]
    got = kmeans_keyed(p, seeds)
    assert sum(got.distances) < 0.7 * len(x) * len(seeds) * got.steps and got.steps > 4
    ws, steps = [(i, np.array(v), c) for i, v, c in seeds], 0
    while True:  # the same loop, every distance looked at
        order = sorted(ws, key=lambda r: (r[2], r[0]))
        index, _ = nearest(np.ascontiguousarray(x.T), [(0, np.array([v for _, v, _ in order]))])
        label = np.array([c for _, _, c in order])[index]
        new = {c: np.array([float(sum(map(Fraction, x[label == c, j].tolist())) / int((label == c).sum())) for j in range(3)]) for c in set(label.tolist())}
        changed = any((new[c] != v).any() for _, v, c in ws if c in new)
        ws, steps = [(i, new[c], c) for i, _, c in ws if c in new], steps + 1
        if not changed:
            break
    assert got.steps == steps and [(i, v.tolist(), c) for i, v, c in got.workset] == [(i, v.tolist(), c) for i, v, c in ws]


def test_keyed_loop_with_odd_points(spark):
    rows = [(i, [float(i % 11), float(i % 3)]) for i in range(60)] + [(100, [math.nan, 1.0]), (101, [math.inf, 2.0])]
    p = pts(spark, rows, with_id=True)
    got = kmeans_keyed(p, [(1, [0.0, 0.0], 1), (2, [9.0, 1.0], 2), (3, [5.0, 1.0], 3)], max_iter=5)
    plain = kmeans(p.select("dims"), [(1, [0.0, 0.0]), (2, [9.0, 1.0]), (3, [5.0, 1.0])], max_iter=got.steps, tol=0.0)
    assert {c: str(v.tolist()) for _, v, c in got.workset} == {int(i): str(v.tolist()) for i, v in zip(plain.centroids.ids, plain.centroids.vectors)}


KEYS = {"double": [1.5, None, math.nan, -0.0, 0.0, 2.0], "date": [datetime.date(2020, 1, 1), None, datetime.date(1969, 1, 1)], "string": ["a", None, "", "é", "NaN"], "bigint": [1, None, 2**62], "boolean": [True, None, False]}


@pytest.mark.parametrize("kind", KEYS)
def test_means_by_keys_of_any_type(spark, kind):
    """The DataFrame form, the table functions in SQL text and SQL's own averages agree."""
    rng = np.random.default_rng(3)
    rows = [(KEYS[kind][i % len(KEYS[kind])], [float(v) for v in rng.integers(-50, 50, 2)]) for i in range(90)]
    df = spark.createDataFrame(rows, f"key {kind}, dims array<double>").repartition(5)
    want = sorted(str(tuple(r)) for r in df.groupBy("key").agg(F.count("*"), F.array(F.avg(F.col("dims")[0]), F.avg(F.col("dims")[1]))).collect())
    assert sorted(str(tuple(r)) for r in update_centroids(df, label="key").collect()) == want
    sql.register(spark)
    got = spark.sql("SELECT * FROM vector_mean(TABLE(SELECT * FROM vector_partials(TABLE({df}))))", df=df)
    assert sorted(str(tuple(r)) for r in got.collect()) == want
    assert vector_mean(df, key="key").count() == 2 * len(want)


def test_table_functions_refuse(spark):
    sql.register(spark)
    df = spark.createDataFrame([(1, [1.0, None]), (1, [1.0])], "key long, dims array<double>")
    for bad in ("SELECT * FROM vector_partials(TABLE({df}))", "SELECT * FROM vector_mean(TABLE(SELECT * FROM {df}))", "SELECT * FROM vector_partials(TABLE(SELECT key, key FROM {df}))"):
        with pytest.raises(Exception, match="DimensionError|takes"):
            spark.sql(bad, df=df).collect()
    with pytest.raises(Exception, match="coordinates"):
        update_centroids(spark.createDataFrame([(1, [1.0, 2.0]), (1, [1.0])], "key long, dims array<double>").repartition(2), label="key").collect()


@pytest.mark.parametrize("bad", [[1.0], [1.0, 2.0, 3.0], [1.0, None], None])
def test_first_step_checks_the_points(spark, bad):
    """No pass of its own, the same error, and nothing stays persisted."""
    p = spark.createDataFrame([([0.0, 0.0],), ([5.0, 0.0],), (bad,)], "dims array<double>").repartition(2)
    held = spark.sparkContext._jsc.sc().getPersistentRDDs().size()
    with pytest.raises(DimensionError):
        kmeans(p, [(1, [0.0, 0.0]), (2, [5.0, 1.0])])
    assert spark.sparkContext._jsc.sc().getPersistentRDDs().size() <= held


@pytest.mark.parametrize("name", ["moved_centroids", "changed_centroids", "relocate_centroids", "gate_on_any_change"])
def test_generations_scan_their_table_twice_at_most(spark, name):
    group = f"scans-{name}"
    spark.sparkContext.setJobGroup(group, name)
    made = catalog.QUERIES[name](spark, SF_SMALL)
    plan = made._jdf.queryExecution().optimizedPlan().toString()
    scans = plan.count("Relation [") + (1 if name == "moved_centroids" else 2)  # the snapshots' own jobs: seeds; seeds and means
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert scans <= 2, plan


def test_keyed_job_from_files_to_file(spark, tmp_path):
    src = {"points": ["1,0 0", "2,1 0", "3,9 9", "4,10 9", "5,1 2,3,4"], "centroids": ["100,0 1,7", "101,9 8,8", "x,1,2,3"]}
    for name, lines in src.items():
        (tmp_path / name).write_text("\n".join(lines))
    out = str(tmp_path / "out")
    labels, result, rejected = run_kmeans_keyed(spark, str(tmp_path / "points"), str(tmp_path / "centroids"), o=out)
    assert rejected == {"points": 1, "centroids": 1}
    assert sorted(r.value for r in spark.read.text(out).collect()) == ["1,0.0 0.0,7", "2,1.0 0.0,7", "3,9.0 9.0,8", "4,10.0 9.0,8"]
    assert [(i, v.tolist(), c) for i, v, c in result.workset] == [(100, [0.5, 0.0], 7), (101, [9.5, 9.0], 8)]
    result.release()


def test_keyed_records_are_size_checked(spark, monkeypatch):
    records = spark.createDataFrame([(i, [0.0] * 4, i) for i in range(50)], "id long, dims array<double>, cluster_id long")
    monkeypatch.setattr(CentroidSet.from_frame.__func__, "__defaults__", ("cluster_id", "dims", None, 100))
    with pytest.raises(ValueError, match="exceeds"):
        kmeans_keyed(pts(spark, [(1, [0.0] * 4)], with_id=True), records)
