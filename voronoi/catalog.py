"""Registered queries: one per operator group of the inventory, each reading
the driver's tables at ``sf_dir`` (see ``sources.tables`` for the point views).

Outputs are flat columns; ids bigint; computed doubles rounded to 6 decimals
(sums of doubles depend on their order, so raw means are never compared).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .functions import sql
from .functions.vectors import (dimension_summary, euclidean_distance, squared_distance,
                                vector_add, vector_scale)
from .operators.assign import assign_by_min, assign_nearest, distance_matrix
from .operators.centroids import CentroidSet
from .operators.converge import changed_centroids, gate_on_any_change, moved_centroids, relocate_centroids
from .operators.update import integer_mean, update_centroids, vector_mean
from .plans.lloyd import kmeans, kmeans_keyed
from .sources import text
from .sources.tables import customer_points, embedding_points, first_points, lineitem_points, table

E_SEEDS = 10
C_SEEDS = 4
TOL = 1e-6
FIXED_STEPS = 5

# The 8 starting centroids for lineitem points
# (l_quantity, l_extendedprice / 1000, l_discount * 100).
L_CENTROIDS = [
    (1, [5.0, 10.0, 2.0]),
    (2, [15.0, 25.0, 8.0]),
    (3, [25.0, 40.0, 5.0]),
    (4, [35.0, 55.0, 3.0]),
    (5, [45.0, 70.0, 7.0]),
    (6, [10.0, 80.0, 1.0]),
    (7, [40.0, 20.0, 9.0]),
    (8, [25.0, 95.0, 4.0]),
]


def r6(c):
    return F.round(c, 6)


def _e(spark, sf):
    return embedding_points(spark, sf)


def _c(spark, sf):
    return customer_points(spark, sf)


def _seeds(points: DataFrame, key: str, k: int) -> CentroidSet:
    """The starting centroids, collected once: every branch of a query uses this snapshot, none scans the table for it again."""
    return CentroidSet.from_few(first_points(points, key, k), k)


def _c_keyed_seeds(pts: DataFrame) -> CentroidSet:
    """Keyed centroid records (id, dims, cluster): the 4 lowest customer keys,
    cluster = their rank 1..4 (a window over the 4 rows of a top-k only)."""
    seeds = pts.orderBy("c_custkey").limit(C_SEEDS)
    w = Window.orderBy("c_custkey")
    rows = seeds.select(F.col("c_custkey").alias("id"), "dims", F.row_number().over(w).cast("bigint").alias("cluster_id"))
    return CentroidSet.from_few(rows, C_SEEDS, "id", label_col="cluster_id")


def _flat2(df: DataFrame, dims: str = "dims", rnd: bool = True) -> list:
    f = r6 if rnd else (lambda c: c)
    return [f(F.col(dims)[0]).alias("d1"), f(F.col(dims)[1]).alias("d2")]


def _long(df: DataFrame, keys: list[str], dims: str, name: str) -> DataFrame:
    ex = df.select(*keys, F.posexplode(dims).alias("pos", "_v"))
    return ex.select(*keys, F.col("pos").cast("int").alias("pos"), r6(F.col("_v")).alias(name))


# ---- sources: text layouts ------------------------------------------------------

def _customer_lines(spark, sf) -> DataFrame:
    """customer rendered as point lines; HOUSEHOLD lines are separators only
    (skipped), MACHINERY lines carry trailing separators (dropped tokens)."""
    c = table(spark, sf, "customer")
    base = F.concat_ws(" ", F.col("c_nationkey").cast("string"), F.col("c_acctbal").cast("string"))
    line = (F.when(F.col("c_mktsegment") == "HOUSEHOLD", F.lit("   "))
            .when(F.col("c_mktsegment") == "MACHINERY", F.concat(base, F.lit("  ")))
            .otherwise(base))
    return c.select("c_custkey", line.alias("value"))


def q_parse_points(spark, sf):
    p = text.parse_points(_customer_lines(spark, sf), d=2)
    return p.select("c_custkey", *_flat2(p, rnd=False), F.size("dims").cast("bigint").alias("n_dims"))


def _mixed_lines(spark, sf) -> DataFrame:
    """customer rendered as lines of one to three coordinates; fractions keep their two places."""
    c = table(spark, sf, "customer")
    n, a, k = (F.col(x).cast("string") for x in ("c_nationkey", "c_acctbal", "c_custkey"))
    line = F.when(F.col("c_mktsegment") == "FURNITURE", a).when(F.col("c_mktsegment") == "BUILDING", F.concat_ws(" ", n, a, k)).otherwise(F.concat_ws(" ", n, a))
    return c.select("c_custkey", line.alias("value"))


def q_parse_mixed_points(spark, sf):
    """Lines of different lengths: no width is given, each line's is found as it is read."""
    p = text.parse_points(_mixed_lines(spark, sf))
    at = [F.get("dims", F.lit(i)).alias(f"d{i + 1}") for i in range(3)]
    return p.select("c_custkey", F.size("dims").cast("bigint").alias("n_dims"), *at)


def q_parse_centroids(spark, sf):
    c = table(spark, sf, "customer")
    lines = c.select(F.concat_ws(" ", F.col("c_custkey").cast("string"), F.col("c_nationkey").cast("string"),
                                 F.col("c_acctbal").cast("string")).alias("value"))
    p = text.parse_centroids(lines, d=2)
    return p.select(F.col("cluster_id").cast("bigint").alias("cluster_id"), *_flat2(p, rnd=False))


def _keyed_lines(spark, sf) -> DataFrame:
    c = table(spark, sf, "customer")
    pt = F.concat_ws(",", F.col("c_custkey").cast("string"),
                     F.concat_ws(" ", F.col("c_nationkey").cast("string"), F.col("c_acctbal").cast("string")))
    line = (F.when(F.col("c_mktsegment") == "AUTOMOBILE", F.concat_ws(",", pt, F.col("c_nationkey").cast("string")))
            .when(F.col("c_mktsegment") == "MACHINERY", F.concat_ws(",", pt, F.col("c_nationkey").cast("string"), F.lit("x")))
            .otherwise(pt))
    return c.select(line.alias("value"))


def q_parse_keyed(spark, sf):
    p = text.parse_keyed(_keyed_lines(spark, sf), d=2)
    return p.select(F.col("id").cast("bigint").alias("id"), *_flat2(p, rnd=False),
                    F.col("cluster_id").cast("bigint").alias("cluster_id"))


def _integer_valued(spark, sf) -> DataFrame:
    c = table(spark, sf, "customer")
    return c.select(F.col("c_custkey"), F.col("c_nationkey").cast("bigint").alias("label"),
                    F.array(F.col("c_custkey").cast("double"), F.col("c_nationkey").cast("double")).alias("dims"),
                    F.array(F.col("c_nationkey").cast("double"), F.floor("c_acctbal").cast("double")).alias("cdims"))


def q_format_labelled_points(spark, sf):
    return text.format_labelled(_integer_valued(spark, sf), label="label", dims="dims")


def q_format_centroids(spark, sf):
    return text.format_centroid_lines(_integer_valued(spark, sf), id_col="c_custkey", dims="cdims")


def q_format_fractions(spark, sf):
    """K1 and K5 on fractions: a labelled line and a centroid line for each customer."""
    c = table(spark, sf, "customer").select("c_custkey", F.col("c_nationkey").cast("bigint").alias("label"), F.array(F.col("c_acctbal"), F.col("c_nationkey") / F.lit(4.0)).alias("dims"))
    return text.format_labelled(c, label="label").unionByName(text.format_centroid_lines(c, id_col="c_custkey"))


def q_keyed_roundtrip(spark, sf):
    c = table(spark, sf, "customer")
    recs = c.select(F.col("c_custkey").alias("id"),
                    F.array(F.col("c_nationkey").cast("double"), F.col("c_acctbal")).alias("dims"),
                    F.col("c_nationkey").alias("cluster_id"))
    back = text.parse_keyed(text.format_keyed(recs), d=2)
    return back.select(F.col("id").cast("bigint").alias("id"), *_flat2(back, rnd=False),
                       F.col("cluster_id").cast("bigint").alias("cluster_id"))


# ---- per-row vector functions ---------------------------------------------

def _with_first(spark, sf) -> DataFrame:
    """Each embedding paired with its label's first vector (one row per label, so no shuffle of the points once that side is small)."""
    e = table(spark, sf, "embeddings").select("vec_id", "label", F.col("embedding").cast("array<double>").alias("dims"))
    first = e.groupBy("label").agg(F.min_by("dims", "vec_id").alias("first_dims")).withColumnRenamed("label", "of")
    return e.join(first, e["label"].eqNullSafe(first["of"]))


def q_squared_distance(spark, sf):
    p = _with_first(spark, sf)
    return p.select("vec_id", r6(squared_distance("dims", "first_dims")).alias("dist2"))


def q_euclidean_distance(spark, sf):
    p = _with_first(spark, sf)
    return p.select("vec_id", r6(euclidean_distance("dims", "first_dims")).alias("dist"))


def q_vector_add(spark, sf):
    p = _with_first(spark, sf)
    return _long(p.select("vec_id", vector_add("dims", "first_dims").alias("v")), ["vec_id"], "v", "value")


def q_vector_scale(spark, sf):
    e = table(spark, sf, "embeddings")
    v = vector_scale(F.col("embedding").cast("array<double>"), (F.col("label") + 1).cast("bigint"))
    return _long(e.select("vec_id", v.alias("v")), ["vec_id"], "v", "value")


def q_dimension_check(spark, sf):
    s = dimension_summary(_e(spark, sf))
    return s.select(*[F.col(c).cast("bigint").alias(c) for c in s.columns])


# ---- assignment -------------------------------------------------------------

def q_distance_matrix(spark, sf):
    e = _e(spark, sf)
    seeds = _seeds(e, "vec_id", E_SEEDS)
    m = distance_matrix(e, seeds, keep=("vec_id",))
    return m.select("vec_id", "cluster_id", r6(F.col("distance")).alias("distance"))


def q_assign_nearest(spark, sf):
    e = _e(spark, sf)
    seeds = _seeds(e, "vec_id", E_SEEDS)
    a = assign_nearest(e, seeds, distance="dist2")
    return a.select("vec_id", "cluster_id", r6(F.col("dist2")).alias("dist2"))


def q_assign_by_cross(spark, sf):
    """Keyed assignment: each customer point takes the *cluster field* of the
    nearest keyed centroid record (the draft's cross + arg-min + write-back)."""
    c = _c(spark, sf)
    a = assign_nearest(c, _c_keyed_seeds(c), distance="dist2")
    return a.select(F.col("c_custkey").alias("id"), "cluster_id",
                    r6(F.sqrt("dist2")).alias("distance"))


def q_assign_by_min(spark, sf):
    """A2: the keyed draft's plan, arg-min per point over candidate rows
    (distance matrix -> least candidate of each task -> groupBy(id).min(struct)),
    so aggregate and shuffle carry n rows, not n x k;
    ``assign_nearest`` gets the same labels with no shuffle at all."""
    e = _e(spark, sf)
    m = distance_matrix(e, _seeds(e, "vec_id", E_SEEDS), keep=("vec_id",), euclidean=False)
    return assign_by_min(m, key="vec_id")


# ---- aggregation ------------------------------------------------------------------

def q_update_centroids(spark, sf):
    e = table(spark, sf, "embeddings").select(F.col("label").cast("bigint").alias("cluster_id"),
                                               F.col("embedding").cast("array<double>").alias("dims"))
    u = update_centroids(e, 64)
    return _long(u, ["cluster_id", "n_points"], "dims", "coord")


def q_vector_mean_udaf(spark, sf):
    e = table(spark, sf, "embeddings").select(F.col("label").cast("bigint").alias("cluster_id"), "embedding")
    m = vector_mean(e, key="cluster_id", dims="embedding", d=64)
    return m.select("cluster_id", "n_points", F.col("pos").cast("int").alias("pos"), r6(F.col("mean")).alias("coord"))


def q_vector_mean_sql(spark, sf):
    """A3 called from SQL text, by a key that is a double and NULL for one label."""
    sql.register(spark)
    e = table(spark, sf, "embeddings").select(F.when(F.col("label") != 3, F.col("label") / 2).alias("half"), "embedding")
    means = spark.sql("SELECT * FROM vector_mean(TABLE(SELECT * FROM vector_partials(TABLE(SELECT half, embedding FROM {e}))))", e=e)
    return _long(means.select(F.col("key").alias("half"), "n_points", "mean"), ["half", "n_points"], "mean", "coord")


def q_cluster_sizes(spark, sf):
    pts = lineitem_points(spark, sf)
    a = assign_nearest(pts, L_CENTROIDS)
    s = a.groupBy("cluster_id").agg(
        F.count(F.lit(1)).alias("n_points"),
        *[r6(F.avg(F.col("dims")[i])).alias(f"m{i + 1}") for i in range(3)])
    return s


def q_integer_centroid_mean(spark, sf):
    li = table(spark, sf, "lineitem")
    lines = li.select("l_returnflag", F.concat_ws(" ", F.col("l_quantity").cast("int").cast("string"),
                                                  F.col("l_linenumber").cast("string")).alias("value"))
    pts = text.parse_int_points(lines, d=2)
    return integer_mean(pts, 2, label="l_returnflag")


def q_integer_mean_signed(spark, sf):
    """M8 where sums are negative too: the quotient is cut towards zero, not down."""
    li = table(spark, sf, "lineitem")
    lines = li.select("l_linenumber", F.concat_ws(" ", (F.col("l_quantity").cast("int") - 26).cast("string"), (F.col("l_quantity").cast("int") - 40).cast("string")).alias("value"))
    return integer_mean(text.parse_int_points(lines, d=2), 2, label="l_linenumber")


# ---- one step and its convergence tests (C, 4 seeds) ------------------------------

def _one_step(spark, sf):
    """(old centroids as a local relation, new ones): one scan for the seeds, one for the step."""
    c = _c(spark, sf)
    seeds = _seeds(c, "c_custkey", C_SEEDS)
    return seeds.to_frame(spark), update_centroids(assign_nearest(c, seeds), 2)


def q_moved_centroids(spark, sf):
    old, new = _one_step(spark, sf)
    m = moved_centroids(new, old, TOL)
    return m.select("cluster_id", "n_points", *_flat2(m), r6(F.col("move2")).alias("move2"))


def _keyed_step(spark, sf):
    """(records, recomputed means) of one generation, both local: the branches that compare and gate them read no table."""
    c = _c(spark, sf)
    recs = _c_keyed_seeds(c)
    means = CentroidSet.from_few(update_centroids(assign_nearest(c, recs), 2), recs.k)
    return recs.to_records(spark), means.to_frame(spark)


def q_changed_centroids(spark, sf):
    recs, means = _keyed_step(spark, sf)
    ch = changed_centroids(recs, means)
    return ch.select("id", "cluster_id")


def q_relocate_centroids(spark, sf):
    recs, means = _keyed_step(spark, sf)
    r = relocate_centroids(recs, means)
    return r.select("id", "cluster_id", *_flat2(r))


def q_gate_on_any_change(spark, sf):
    recs, means = _keyed_step(spark, sf)
    nxt = relocate_centroids(recs, means)
    g = gate_on_any_change(changed_centroids(recs, means), nxt)
    return g.select("id", "cluster_id", *_flat2(g))


# ---- iterations ------------------------------------------------------------------

def q_kmeans_fixed_n(spark, sf):
    c = _c(spark, sf)
    r = kmeans(c, _seeds(c, "c_custkey", C_SEEDS), keep=["c_custkey"], max_iter=FIXED_STEPS, check=False)
    r.release()
    out = r.centroid_frame()
    return out.select(F.col("cluster_id"), *_flat2(out), F.lit(r.steps).cast("bigint").alias("steps"))


def _kmeans_e(spark, sf):
    e = _e(spark, sf)
    return kmeans(e, _seeds(e, "vec_id", E_SEEDS), keep=["vec_id"], tol=TOL)


def q_kmeans_converged(spark, sf):
    r = _kmeans_e(spark, sf)
    r.release()
    out = _long(r.centroid_frame(), ["cluster_id"], "dims", "coord")
    return out.withColumn("steps", F.lit(r.steps).cast("bigint"))


def q_kmeans_labels(spark, sf):
    r = _kmeans_e(spark, sf)
    r.release()
    return r.labels(keep=["vec_id"])


def q_kmeans_sizes(spark, sf):
    """Flagship: converged K-Means on the embeddings, points per cluster."""
    r = _kmeans_e(spark, sf)
    r.release()
    return r.labels(keep=[]).groupBy("cluster_id").agg(F.count(F.lit(1)).alias("n_points"))


def q_kmeans_keyed(spark, sf):
    c = _c(spark, sf).select(F.col("c_custkey").alias("id"), "dims")
    r = kmeans_keyed(c, _c_keyed_seeds(_c(spark, sf)))
    r.release()
    return r.labels(keep=["id"]).select("id", "cluster_id", F.lit(r.steps).cast("bigint").alias("steps"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "parse_points": q_parse_points,
    "parse_mixed_points": q_parse_mixed_points,
    "parse_centroids": q_parse_centroids,
    "parse_keyed": q_parse_keyed,
    "format_labelled_points": q_format_labelled_points,
    "format_centroids": q_format_centroids,
    "format_fractions": q_format_fractions,
    "keyed_roundtrip": q_keyed_roundtrip,
    "squared_distance": q_squared_distance,
    "euclidean_distance": q_euclidean_distance,
    "distance_matrix": q_distance_matrix,
    "vector_add": q_vector_add,
    "vector_scale": q_vector_scale,
    "dimension_check": q_dimension_check,
    "assign_nearest": q_assign_nearest,
    "assign_by_cross": q_assign_by_cross,
    "assign_by_min": q_assign_by_min,
    "update_centroids": q_update_centroids,
    "vector_mean_udaf": q_vector_mean_udaf,
    "vector_mean_sql": q_vector_mean_sql,
    "cluster_sizes": q_cluster_sizes,
    "integer_centroid_mean": q_integer_centroid_mean,
    "integer_mean_signed": q_integer_mean_signed,
    "moved_centroids": q_moved_centroids,
    "changed_centroids": q_changed_centroids,
    "relocate_centroids": q_relocate_centroids,
    "gate_on_any_change": q_gate_on_any_change,
    "kmeans_fixed_n": q_kmeans_fixed_n,
    "kmeans_converged": q_kmeans_converged,
    "kmeans_labels": q_kmeans_labels,
    "kmeans_sizes": q_kmeans_sizes,
    "kmeans_keyed": q_kmeans_keyed,
}
