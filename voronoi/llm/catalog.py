"""The corpus queries opN_<name>: each applies its operator, with production parameters, to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import bloom_lm, bpe, embedding_dedup, exact_dedup, importance, licenses, mixing, ngram_join, prefix_trie, secrets, suffix_dedup, token_align, url_filter
from .common import table


def op1_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_embeddings(table(spark, sf_dir, "embeddings"))


def op2_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = exact_dedup.exact_dedup(table(spark, sf_dir, "documents"))
    return made.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(table(spark, sf_dir, "pages"), url_filter.RULES)


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op6_bloom_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bloom_lm.score_documents(table(spark, sf_dir, "documents"))


def op7_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(table(spark, sf_dir, "documents")).drop("kept")


def op9_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.jaccard_groups(table(spark, sf_dir, "documents"), n=3, t=90)


def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return bpe.encode_texts(table(spark, sf_dir, "documents"), bpe.read_spec(public_tokenizers.path("byte_bpe_50k.json")))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.conversation_trie(table(spark, sf_dir, "conversations"))


def op12_token_align(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    spec, model = token_align.read_spec(public_tokenizers.path("byte_bpe_50k.json")), token_align.read_model(public_tokenizers.path("piece_bpe_32k.model"))
    return token_align.align_texts(table(spark, sf_dir, "documents"), spec, model)


def op13_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.find_secrets(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_embedding_dedup": op1_embedding_dedup,
    "op2_licenses": op2_licenses,
    "op3_exact_dedup": op3_exact_dedup,
    "op4_url_filter": op4_url_filter,
    "op5_mixing": op5_mixing,
    "op6_bloom_lm": op6_bloom_lm,
    "op7_importance": op7_importance,
    "op8_suffix_dedup": op8_suffix_dedup,
    "op9_ngram_join": op9_ngram_join,
    "op10_bpe": op10_bpe,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_token_align": op12_token_align,
    "op13_secrets": op13_secrets,
}

ORACLE_SQL: dict[str, str] = {
    "op3_exact_dedup": """
SELECT doc_id, max(doc_id) OVER t AS keep_id, count(*) OVER t AS group_size, doc_id = max(doc_id) OVER t AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW t AS (PARTITION BY coalesce(text, ''))
""",
    "op4_url_filter": url_filter.SQL,
    "op5_mixing": mixing.SQL,
    "op11_prefix_trie": prefix_trie.SQL,
}
