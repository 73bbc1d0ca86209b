"""Connected components of a table of links, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import durable


def _with_least(links: DataFrame) -> DataFrame:
    """Each link (u, v) with m, the least of u and its neighbours. The table of least nodes is written first, so that the join can
    split a node with very many links."""
    least = durable(links.groupBy("u").agg(F.min("v").alias("m")))
    return links.join(least, "u").withColumn("m", F.least("u", "m"))


def components(links: DataFrame, u: str = "u", v: str = "v") -> DataFrame:
    """(node, root) for every node of a link: root is the least node that links reach. Every step writes its links to the shared
    folder; self links and repeated links do no harm."""
    edges = durable(links.select(F.greatest(u, v).cast("long").alias("u"), F.least(u, v).cast("long").alias("v")).distinct())
    if edges.isEmpty():
        return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    state = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = durable(_with_least(both).where("v > u or v = u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        near = _with_least(large.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")))
        edges = durable(near.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(near.select("u", F.col("m").alias("v"))).distinct())
        now = edges.agg(F.count("*"), F.expr("bit_xor(xxhash64(u, v))")).first()
        if now == state:
            return edges.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("root"))
        state = now
