"""The corpus pipeline: stages over ``documents``, each written as Parquet and read again as the next one's documents.

All stages but the last return rows of their input, with all its columns, whatever their names; an empty table gives an empty table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from voronoi.llm import bpe, exact_dedup, importance, mixing, ngram_join
from voronoi.llm.common import durable, table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that importance resampling takes; those it rejects go.

    Null and empty texts have log importance 0; rows that tie with the last one taken are taken too, rows that repeat id and text share one
    decision. If no document is labelled good, all stay."""
    return importance.Resampled(docs, table(spark, sf_dir, "labels")).taken(docs)


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents with equal texts the one with the largest id stays, null ids counting as less than any; null and empty texts are equal.
    Of rows that repeat id and text one stays."""
    return exact_dedup.drop_copies(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of documents linked by five-word shingles with a similarity of 0.8 or more the row with the least id stays, null ids
    after all others. Documents without words stay; another row that has the id of a dropped one isn't touched."""
    return ngram_join.keep_one(docs, n=5, t=80)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as many times as the mix of their sources takes them; a null source is a source of its own, documents without words have
    size 0, rows that repeat id and text share one decision."""
    return mixing.take(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The ids of every document, with their digests; one row per row, null and empty texts have no ids."""
    import public_tokenizers

    return bpe.encode_texts(docs, bpe.read_spec(public_tokenizers.path("byte_bpe_50k.json")), with_ids=True)


STAGES = [("quality", quality), ("exact_dedup", exact_copies), ("ngram_join", near_copies), ("mixing", mix_sources), ("bpe", encode)]

#: Encoding isn't expressible in SQL; the stages are tested against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = durable(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
