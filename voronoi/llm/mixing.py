"""Mixing sources to target weights by Pareto order sampling.

Each source gets a target number of words. A target of t times the source's size takes every document floor(t) whole times; the rest
comes from a sample without replacement in which a document's inclusion probability is p = t - floor(t). Documents are ranked by
their random odds U/(1-U) divided by their inclusion odds p/(1-p), and the sample is the start of that order whose words come
nearest to the rest. U is a hash of the id, so reruns agree.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import durable, positional

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST = 2.0
SEED = "mix"
#: Bins of the rank at each of the two passes that look for a source's last document; powers of two keep the edges exact.
BINS = 4096
#: Sources up to which their table (a few numbers each) is broadcast; more are joined by a shuffle.
BROADCAST_SOURCES = 100_000


def words(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long")


def uniform(id_col: Column, text: Column, seed: str = SEED) -> Column:
    """A number in (0, 1) from the id; from the text where the id is null."""
    key = F.concat(F.lit(seed + ":"), F.coalesce(id_col.cast("string"), F.md5(F.coalesce(text, F.lit("")))))
    return (F.conv(F.substring(F.md5(key), 1, 13), 16, 10).cast("long").cast("double") + 0.5) / float(1 << 52)


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """From (source, size) one row per source: source, source_size, target, whole (copies of every document), rest (words), p.

    Sources in code point order, null last, weigh ``weights`` in turn. No target is above ``most`` times its source's size: with the
    sources in order of the level at which they reach that bound, the level of the free ones follows from two running sums at the first
    source that stays below it; the later ones would give less."""
    cap = F.col("source_size") * most
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    order = F.row_number().over(Window.orderBy(F.asc_nulls_last("source"))) - 1
    per = per.withColumn("w", F.element_at(F.array(*map(F.lit, weights)), (order % len(weights) + 1).cast("int")).cast("double")).withColumn("full_at", cap / F.col("w"))
    by = Window.orderBy("full_at", F.asc_nulls_last("source"))
    total = F.sum("source_size").over(Window.partitionBy()) * share
    before = F.coalesce(F.sum(cap).over(by.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    free = F.sum("w").over(by.rowsBetween(0, Window.unboundedFollowing))
    per = per.withColumn("at", (total - before) / free)
    level = F.max(F.when(F.col("at") <= F.col("full_at"), F.col("at"))).over(Window.partitionBy())
    per = per.withColumn("target", F.least(F.coalesce(F.col("w") * level, cap), cap))
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    per = per.withColumn("whole", whole)
    rest = F.col("target") - F.col("whole") * F.col("source_size")
    return per.select("source", "source_size", "target", "whole", rest.alias("rest"), F.when(F.col("source_size") > 0, rest / F.col("source_size")).otherwise(0.0).alias("p"))


def _with_source(df: DataFrame, per: DataFrame, columns: list[str], small: bool) -> DataFrame:
    side = per.select(F.col("source").alias("_src"), *[F.col(c).alias(f"_{c}") for c in columns])
    return df.join(F.broadcast(side) if small else side, df["source"].eqNullSafe(F.col("_src")), "left").drop("_src")


def rank(u: Column, p: Column) -> Column:
    """Pareto rank q, random odds over inclusion odds, as q/(1+q) in [0, 1)."""
    q = (u / (1 - u)) / (p / (1 - p))
    return F.when((p > 0) & (p < 1), q / (1 + q)).otherwise(F.lit(0.0))


def plan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **how) -> tuple[DataFrame, DataFrame, bool]:
    """(sized rows: id, source, size, u; per source its targets and the place in its order where the sample ends; whether that table is small)."""
    sized = durable(docs.select(F.col(id_col).cast("long").alias("id"), F.col(source_col).alias("source"), words(F.col(text_col)).alias("size"), uniform(F.col(id_col), F.col(text_col)).alias("u")))
    per = durable(targets(sized, **how))
    small = per.count() <= BROADCAST_SOURCES
    rows = _with_source(sized, per, ["p", "rest"], small).where("_p > 0 and size > 0").withColumn("k", rank(F.col("u"), F.col("_p")))
    rows = rows.select("source", "size", "k", F.coalesce("id", F.lit(-1)).alias("id"), F.col("_rest").alias("rest"), F.floor(F.col("k") * BINS).alias("b1"))
    rows = rows.withColumn("b2", F.floor((F.col("k") * BINS - F.col("b1")) * BINS))
    # the bin, then the finer bin, in which the running sum of words passes the rest
    first = _passing(rows.groupBy("source", "b1").agg(F.sum("size").alias("n"), F.max("rest").alias("rest")).withColumn("from", F.lit(0)), "b1")
    inner = _within(rows, first, ["b1"], small)
    second = durable(_passing(inner.groupBy("source", "b1", "b2").agg(F.sum("size").alias("n"), F.max("rest").alias("rest"), F.max("from").alias("from")), "b2"))
    last = _within(inner.drop("from"), second, ["b1", "b2"], small).groupBy("source", "b1", "b2", "k", "id").agg(F.sum("size").alias("n"), F.max("rest").alias("rest"), F.max("from").alias("from"))
    upto = F.sum("n").over(Window.partitionBy("source").orderBy("k", "id").rowsBetween(Window.unboundedPreceding, 0)) + F.col("from")
    out = F.when(upto - F.col("n") / 2 > F.col("rest"), F.struct("k", "id"))
    edge = (F.col("b1") + (F.col("b2") + 1) / BINS) / BINS
    ends = last.withColumn("out", out).groupBy("source").agg(F.coalesce(F.min("out"), F.struct(F.max(edge).alias("k"), F.lit(-(1 << 62)).alias("id"))).alias("end"))
    ends = ends.select(F.col("source").alias("_s"), F.col("end.k").alias("end_k"), F.col("end.id").alias("end_id"))
    per = per.join(ends, per["source"].eqNullSafe(ends["_s"]), "left").drop("_s")
    return sized, durable(per), small


def _passing(bins: DataFrame, bin_col: str) -> DataFrame:
    """Of each source's bins the one in which the running sum, begun at ``from``, passes ``rest``."""
    upto = F.sum("n").over(Window.partitionBy("source").orderBy(bin_col).rowsBetween(Window.unboundedPreceding, 0)) + F.col("from")
    return bins.withColumn("upto", upto).where("upto > rest and upto - n <= rest").withColumn("from", F.col("upto") - F.col("n")).drop("upto", "n")


def _within(rows: DataFrame, bins: DataFrame, on: list[str], small: bool) -> DataFrame:
    side = bins.select(F.col("source").alias("_s"), *[F.col(c).alias(f"_{c}") for c in on], "from")
    same = rows["source"].eqNullSafe(side["_s"])
    for c in on:
        same = same & (rows[c] == side[f"_{c}"])
    return rows.join(F.broadcast(side) if small else side, same).drop("_s", *[f"_{c}" for c in on])


def _copies(u: Column, id_col: Column) -> Column:
    k = rank(u, F.col("_p"))
    before = F.struct(k.alias("k"), F.coalesce(id_col.cast("long"), F.lit(-1).cast("long")).alias("id")) < F.struct(F.col("_end_k").alias("k"), F.col("_end_id").alias("id"))
    return (F.coalesce(F.col("_whole"), F.lit(0)) + F.when(F.coalesce(before, F.lit(False)) & (F.col("_p") > 0), 1).otherwise(0)).cast("long")


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **how) -> DataFrame:
    """One row per row of ``docs``: doc_id, source, size, source_size, target, copies, taken (words, copies counted).

    A null text has size 0, a null source is a source of its own, rows that repeat an id and text share one decision, an empty table
    gives no rows."""
    sized, per, small = plan(docs, id_col, text_col, source_col, **how)
    rows = _with_source(sized, per, ["source_size", "target", "whole", "p", "end_k", "end_id"], small).withColumn("copies", _copies(F.col("u"), F.col("id")))
    return rows.select(F.col("id").alias("doc_id"), "source", "size", F.col("_source_size").alias("source_size"), F.col("_target").alias("target"), "copies", (F.col("copies") * F.col("size")).alias("taken"))


def take(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **how) -> DataFrame:
    """The rows of ``docs``, with all their columns, whatever their names, each as many times as the mix takes it; texts aren't shuffled
    when the table of sources is small.

    Texts without words have size 0 and come as many whole times as their source does; a null source is a source of its own; rows that repeat an id and
    text share one decision; an empty table gives no rows."""
    plain, (id_col, text_col, source_col), named = positional(docs, id_col, text_col, source_col)
    _, per, small = plan(plain, id_col, text_col, source_col, **how)
    side = per.select(F.col("source").alias("_src"), *[F.col(c).alias(f"_{c}") for c in ("whole", "p", "end_k", "end_id")])
    rows = plain.join(F.broadcast(side) if small else side, F.col(source_col).eqNullSafe(F.col("_src")), "left")
    copies = _copies(uniform(F.col(id_col), F.col(text_col)), F.col(id_col))
    return named(rows.withColumn("_again", F.array_repeat(F.lit(1), copies.cast("int"))).withColumn("_again", F.explode("_again")).select(*plain.columns))


SQL = rf"""
WITH RECURSIVE d AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '{WORD}')) AS BIGINT) AS size,
         (CAST(('0x' || substr(md5('{SEED}:' || coalesce(CAST(doc_id AS VARCHAR), md5(coalesce(text, '')))), 1, 13)) AS BIGINT) + 0.5::DOUBLE) / 4503599627370496::DOUBLE AS u
  FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
w AS (SELECT *, CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 3.0::DOUBLE WHEN 1 THEN 1.0::DOUBLE ELSE 2.0::DOUBLE END AS w FROM s),
it AS (
  SELECT 0 AS r, source, source_size, w, source_size * 2.0::DOUBLE AS cap, false AS capped FROM w
  UNION ALL
  SELECT r + 1, source, source_size, w, cap,
         capped OR w * (1.5::DOUBLE * sum(source_size) OVER () - coalesce(sum(cap) FILTER (capped) OVER (), 0)) / (sum(w) FILTER (NOT capped) OVER ()) > cap
  FROM it WHERE r < 60),
t AS (SELECT source, source_size, CASE WHEN capped THEN cap
             ELSE w * ((1.5::DOUBLE * sum(source_size) OVER () - coalesce(sum(cap) FILTER (capped) OVER (), 0)) / (sum(w) FILTER (NOT capped) OVER ())) END AS target
      FROM it WHERE r = 60),
p AS (SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS whole FROM t),
r AS (SELECT *, target - whole * source_size AS rest, CASE WHEN source_size > 0 THEN (target - whole * source_size) / source_size ELSE 0 END AS p FROM p),
k AS (SELECT d.doc_id, d.size, r.*, CASE WHEN p > 0 AND p < 1 THEN ((u / (1 - u)) / (p / (1 - p))) / (1 + (u / (1 - u)) / (p / (1 - p))) ELSE 0 END AS k
      FROM d JOIN r ON d.source IS NOT DISTINCT FROM r.source),
c AS (SELECT source, k, coalesce(doc_id, -1) AS id, sum(size) AS n, max(rest) AS rest FROM k WHERE p > 0 AND size > 0 GROUP BY source, k, coalesce(doc_id, -1)),
i AS (SELECT source, k, id, sum(n) OVER (PARTITION BY source ORDER BY k, id) - n / 2.0::DOUBLE <= rest AS taken FROM c)
SELECT k.doc_id, k.size, k.source_size, k.target, CAST(k.size * (whole + CASE WHEN i.taken THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM k LEFT JOIN i ON k.source IS NOT DISTINCT FROM i.source AND k.k = i.k AND coalesce(k.doc_id, -1) = i.id
"""
