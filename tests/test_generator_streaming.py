import os

from pyspark.sql import functions as F

from voronoi.plans.lloyd import kmeans
from voronoi.sources.generator import generate_mixture, true_means, two_decimals, write_generated
from voronoi.sources.text import read_centroids, read_points
from voronoi.streaming import label_stream, read_point_stream


def test_generator_is_partition_independent(spark):
    a, ca = generate_mixture(spark, 1000, 4, seed=7, num_partitions=1)
    b, cb = generate_mixture(spark, 1000, 4, seed=7, num_partitions=13)
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))
    assert [r.cluster_id for r in ca.collect()] == [1, 2, 3, 4]
    assert all(-50 <= x < 50 for r in ca.collect() for x in r.dims)


def test_generator_recovers_mixture(spark):
    p, _ = generate_mixture(spark, 2000, 4, seed=11)
    r = kmeans(p, true_means(spark, 4, seed=11), keep=["id"])
    sizes = sorted(x["count"] for x in r.labels().groupBy("cluster_id").count().collect())
    assert sizes == [500, 500, 500, 500]


def test_generator_text_files(spark, tmp_path):
    p, c = generate_mixture(spark, 50, 3, seed=3)
    write_generated(p, c, str(tmp_path))
    back = read_points(spark, str(tmp_path / "points"))
    assert back.count() == 50
    assert read_centroids(spark, str(tmp_path / "centers")).count() == 3
    s = spark.createDataFrame([([1.005, -2.0, 2.345],)], "dims array<double>").select(two_decimals(F.col("dims"))).first()[0]
    assert s.split(" ")[1:] == ["-2.00", "2.34"]


def test_streaming_labels(spark, tmp_path):
    src = tmp_path / "in"
    os.makedirs(src)
    (src / "a.txt").write_text("0 0\n10 10\n")
    (src / "b.txt").write_text("9 9\n1 1\n")
    stream = label_stream(read_point_stream(spark, str(src)), [(1, [0.0, 0.0]), (2, [10.0, 10.0])])
    q = (stream.writeStream.format("memory").queryName("labels_out")
         .option("checkpointLocation", str(tmp_path / "ckpt")).start())
    q.processAllAvailable()
    q.stop()
    got = sorted((r.dims[0], r.cluster_id) for r in spark.sql("select * from labels_out").collect())
    assert got == [(0.0, 1), (1.0, 1), (9.0, 2), (10.0, 2)]


def test_end_to_end_text_job(spark, tmp_path):
    """generate -> text files (',' separated) -> run_kmeans(-p -c -s -o) -> labelled lines."""
    from voronoi.plans.cli import run_kmeans
    from voronoi.sources.text import format_centroid_lines, format_point_lines, write_lines

    p, _ = generate_mixture(spark, 600, 3, seed=5)
    write_lines(format_point_lines(p, sep=","), str(tmp_path / "data.csv"))
    seeds = true_means(spark, 3, seed=5).withColumn("cluster_id", F.col("cluster_id") + 1)
    write_lines(format_centroid_lines(seeds, sep=","), str(tmp_path / "centroids.csv"))
    out = str(tmp_path / "Results")
    labels, result = run_kmeans(spark, str(tmp_path / "data.csv"), str(tmp_path / "centroids.csv"),
                                n=100, k="true", t=1e-6, s=",", o=out)
    assert result.converged and result.centroids.ids.tolist() == [1, 2, 3]
    lines = [r.value for r in spark.read.text(out).collect()]
    assert len(lines) == 600
    counts = {}
    for line in lines:
        cid, coords = line.split("\t")
        assert len(coords.split(" ")) == 5
        counts[cid] = counts.get(cid, 0) + 1
    assert counts == {"1": 200, "2": 200, "3": 200}
    result.release()
