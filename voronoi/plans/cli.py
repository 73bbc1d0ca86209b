"""The job entry point (I5): the reference's arguments as keyword arguments,
plus a thin ``spark-submit`` wrapper.

    spark-submit -m voronoi.plans.cli -p points.txt -c centers.txt -o out/ -s ' '
    spark-submit -m voronoi.plans.cli --keyed -p samples.csv -c centroids.csv -o out/

-c centroid path, -p point path (each falls back to the built-in table),
-n step limit (100), -o output path (else printed), -k check convergence
("true", else off), -t threshold (1e-6), -s separator (one blank; a literal).
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import DataFrame, Observation, SparkSession

from ..sources.defaults import default_centroids, default_points
from ..sources.text import format_keyed, format_labelled, read_centroids, read_keyed, read_points, write_keyed, write_labelled
from .lloyd import DEFAULT_MAX_ITER, DEFAULT_TOL, KeyedResult, KMeansResult, kmeans, kmeans_keyed


def run_kmeans(spark: SparkSession, points: str | None = None, centroids: str | None = None,
               n: int = DEFAULT_MAX_ITER, k: bool | str = True, t: float = DEFAULT_TOL, s: str = " ",
               o: str | None = None, engine: str = "auto") -> tuple[DataFrame, KMeansResult]:
    """Parse (or default) the inputs, run the loop, label the points, and
    write ``cluster TAB d1 d2 ...`` lines to ``o`` (overwrite) when given."""
    check = k if isinstance(k, bool) else str(k).lower() == "true"
    pts = read_points(spark, points, s) if points else default_points(spark)
    cts = read_centroids(spark, centroids, s) if centroids else default_centroids(spark)
    result = kmeans(pts, cts, max_iter=n, tol=t, check=check, engine=engine)
    labels = result.labels()
    if o:
        write_labelled(labels, o)
    return labels, result


def run_kmeans_keyed(spark: SparkSession, points: str, centroids: str, n: int = DEFAULT_MAX_ITER,
                     o: str | None = None) -> tuple[DataFrame, KeyedResult, dict[str, int]]:
    """The keyed job from files to file: reads ``id,d1 d2 ...`` points and ``id,d1 d2 ...,cluster`` records, runs the
    keyed loop and writes ``id,d1 d2 ...,cluster`` lines, which it could read again, to ``o`` (overwrite) when given.

    Returns the labelled points, the result and how many lines of either file had four or more fields and were dropped (counted by the
    passes that read the files)."""
    seen = {"points": Observation(), "centroids": Observation()}
    pts = read_keyed(spark, points, rejected=seen["points"])
    records = read_keyed(spark, centroids, rejected=seen["centroids"])
    result = kmeans_keyed(pts, records, max_iter=n)
    labels = result.labels(keep=["id", "dims"])
    if o:
        write_keyed(labels, o)
    return labels, result, {name: int(x.get["rejected"]) for name, x in seen.items()}


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(description="K-Means clustering of text point files")
    ap.add_argument("-p", dest="points")
    ap.add_argument("-c", dest="centroids")
    ap.add_argument("-n", type=int, default=DEFAULT_MAX_ITER)
    ap.add_argument("-o", dest="out")
    ap.add_argument("-k", default="true")
    ap.add_argument("-t", type=float, default=DEFAULT_TOL)
    ap.add_argument("-s", default=" ")
    ap.add_argument("--keyed", action="store_true", help="the keyed layout; -p and -c are needed, -n and -o taken")
    a = ap.parse_args(argv)
    spark = SparkSession.builder.appName("voronoi-kmeans").getOrCreate()
    if a.keyed:
        if not a.points or not a.centroids:
            ap.error("--keyed needs -p and -c")
        labels, keyed, rejected = run_kmeans_keyed(spark, a.points, a.centroids, a.n, a.out)
        if not a.out:
            for line in format_keyed(labels).toLocalIterator():
                print(line[0])
        print(f"steps={keyed.steps} k={len(keyed.workset)} rejected={rejected}", file=sys.stderr)
        keyed.release()
        return
    labels, result = run_kmeans(spark, a.points, a.centroids, a.n, a.k, a.t, a.s, a.out)
    if not a.out:
        for line in format_labelled(labels).toLocalIterator():  # all lines, one partition at a time
            print(line[0])
    print(f"steps={result.steps} converged={result.converged} k={result.centroids.k}", file=sys.stderr)
    result.release()


if __name__ == "__main__":
    main()
