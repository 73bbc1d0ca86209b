"""Small helpers shared by the corpus operators: tables, durable results, bounded row filters."""

from __future__ import annotations

import math
import tempfile
import uuid

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given Parquet tables."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder named in ``spark.checkpoint.dir``. Only a local session without one gets a folder of its own."""
    sc = spark.sparkContext
    named = sc.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if named:
        return named
    if not sc.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="corpus-ckpt-"))
    return sc.getCheckpointDir()


def durable(df: DataFrame) -> DataFrame:
    """Write a frame to the shared folder as Parquet and read it back: lineage ends there, so a lost executor costs only
    the tasks that ran on it, and the frame can be read several times. The files go when the application ends."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/tables/{uuid.uuid4().hex}"
    df.write.parquet(path)
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(hadoop)
    return spark.read.schema(df.schema).parquet(path)


def positional(docs: DataFrame, *columns: str):
    """(``docs`` with columns c0, c1, ..., the new names of ``columns``, a function that gives a frame of all these columns its names back):
    an operator that keeps all columns can then use names of its own."""
    names = docs.columns
    plain = docs.toDF(*[f"c{i}" for i in range(len(names))])
    return plain, [f"c{names.index(c)}" for c in columns], lambda df: df.select(*plain.columns).toDF(*names)


def maybe_in(df: DataFrame, key: Column, keys: DataFrame, keys_key: Column, max_bits: int = 1 << 24) -> DataFrame:
    """The rows of ``df`` whose ``key`` may be among ``keys`` (never losing one that is), without a shuffle of ``df``.

    ``keys`` become a bitmap of at most ``max_bits`` bits, kept as rows of 64 bits, which is broadcast: max_bits / 64 rows
    whatever the number of keys. A fuller bitmap only lets more rows pass to the exact join that must follow. ``df`` has no columns
    _p, _word, _bits, _hit (see ``positional``)."""
    return _with_bit(df, key, keys, keys_key, max_bits).where("_hit").drop("_hit")


def split_by(df: DataFrame, key: Column, keys: DataFrame, keys_key: Column, max_bits: int = 1 << 24) -> tuple[DataFrame, DataFrame]:
    """(rows that may be among ``keys``, rows that are not), by the bitmap of ``maybe_in``."""
    marked = _with_bit(df, key, keys, keys_key, max_bits)
    return marked.where("_hit").drop("_hit"), marked.where("not _hit").drop("_hit")


def _with_bit(df: DataFrame, key: Column, keys: DataFrame, keys_key: Column, max_bits: int) -> DataFrame:
    bits = min(max_bits, 1 << max(10, math.ceil(math.log2(16 * max(1, keys.count())))))
    at = lambda k: F.pmod(F.xxhash64(k), F.lit(bits))
    words = (
        keys.select(at(keys_key).alias("_p"))
        .groupBy((F.col("_p") / 64).cast("long").alias("_word"))
        .agg(F.bit_or(F.expr("shiftleft(1L, cast(_p % 64 as int))")).alias("_bits"))
    )
    marked = df.withColumn("_p", at(key)).withColumn("_word", (F.col("_p") / 64).cast("long"))
    hit = F.expr("coalesce(shiftrightunsigned(_bits, cast(_p % 64 as int)) & 1L, 0L) = 1L")
    return marked.join(F.broadcast(words), "_word", "left").withColumn("_hit", hit).drop("_p", "_word", "_bits")


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def give_back() -> None:
    """Gives freed memory back to the system."""
    import ctypes

    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def trimmed(run):
    """The kernel ``run`` (of batches, or of a group's table), which gives freed memory back to the system when it ends: a worker lives through many tasks and
    would keep what the largest of them has touched."""

    def kernel(given):
        if isinstance(given, pa.Table):
            try:
                return run(given)
            finally:
                give_back()
        return batches(given)

    def batches(given):
        try:
            yield from run(given)
        finally:
            give_back()

    return kernel
