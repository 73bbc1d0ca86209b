"""Convergence tests between two centroid generations.

Each takes and returns DataFrames of k rows; the joins are equi-joins on the
centroid key between two tiny tables. The Lloyd loop evaluates the same rules
on the k rows it already holds on the driver (``moved_ids``, ``changed``) so a
step stays one Spark job.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.vectors import squared_distance


def moved_centroids(new: DataFrame, old: DataFrame, tol: float, *, key: str = "cluster_id",
                    dims: str = "dims") -> DataFrame:
    """J2 + F1: new centroids whose squared move from the old centroid with the
    same id is >= tol^2. A NaN move counts as converged; ids present on one side
    only are not compared (a vanished cluster does not block convergence)."""
    o = old.select(F.col(key), F.col(dims).alias("_old"))
    move2 = squared_distance(F.col(dims), F.col("_old"))
    joined = new.join(o, key).withColumn("move2", move2)
    return joined.where(~F.isnan("move2") & (F.col("move2") >= F.lit(float(tol) * float(tol)))).drop("_old")


def changed_centroids(old: DataFrame, new: DataFrame, *, key: str = "cluster_id",
                      dims: str = "dims") -> DataFrame:
    """J3 + F2: pairs (joined on the cluster) where any coordinate differs."""
    n = new.select(F.col(key), F.col(dims).alias("_new"))
    diff = F.exists(F.zip_with(F.col(dims), F.col("_new"), lambda a, b: a != b), lambda x: x)
    return old.join(n, key).where(diff | (F.size(dims) != F.size("_new")))


def relocate_centroids(workset: DataFrame, relocated: DataFrame, *, key: str = "cluster_id",
                       id_col: str = "id", dims: str = "dims") -> DataFrame:
    """J3 + M10: each old centroid record keeps its id and cluster and takes
    the recomputed mean of its cluster. Clusters without a mean drop out."""
    r = relocated.select(F.col(key), F.col(dims).alias("_mean"))
    return workset.join(r, key).select(id_col, F.col("_mean").alias(dims), key)


def gate_on_any_change(flags: DataFrame, workset: DataFrame) -> DataFrame:
    """J5 + M13 + L1: the whole workset if ``flags`` has at least one row, else
    nothing. An uncorrelated EXISTS: evaluated once, no cross product."""
    return workset.where(flags.select(F.lit(True).alias("flag")).limit(1).exists())


# ---- the same rules on the k rows the driver loop holds ----------------------

def squared_move(a: np.ndarray, b: np.ndarray) -> float:
    """Sequential sum of squared differences (order of the reference loop)."""
    s = 0.0
    for x, y in zip(a.tolist(), b.tolist()):
        t = y - x
        s += t * t
    return s


def any_moved(new: dict[int, np.ndarray], old_pairs, tol: float) -> bool:
    """F1 over (id, vector) pairs of the old generation (duplicates allowed)."""
    t2 = float(tol) * float(tol)
    for cid, vec in old_pairs:
        if cid in new:
            m = squared_move(new[cid], vec)
            if not math.isnan(m) and m >= t2:
                return True
    return False


def any_changed(new: dict[int, np.ndarray], old_pairs) -> bool:
    """F2 over (cluster, vector) pairs: any coordinate differs."""
    for cid, vec in old_pairs:
        if cid in new:
            nv = new[cid]
            if nv.shape != vec.shape or bool(np.any(nv != vec)):
                return True
    return False
