"""Every registered corpus query on small tables, in a session whose workers can't import the package: kernels must travel by value."""

import json
import subprocess
import sys
import textwrap
from pathlib import Path

import duckdb
import pytest

ROOT = Path(__file__).resolve().parents[2]
TABLES = {"documents": "doc_id < 60", "labels": "doc_id < 60", "embeddings": "vec_id < 60", "pages": "page_id < 60", "conversations": "conv_id < 25"}

RUN = """
    import json, sys
    sys.path.insert(0, sys.argv[1])  # the driver alone
    from pyspark.sql import SparkSession
    spark = SparkSession.builder.master("local[4]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "3").config("spark.driver.memory", "2g").getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")

    def lacking(_):
        try:
            import voronoi
        except ModuleNotFoundError:
            return [True]
        return [False]

    import corpus_pipeline
    from voronoi.llm.catalog import QUERIES
    out = {"lacking": all(spark.sparkContext.parallelize([1], 1).flatMap(lacking).collect())}
    for name, query in {**QUERIES, "pipeline": corpus_pipeline.run}.items():
        df = query(spark, sys.argv[2])
        out[name] = [df.count(), df.columns]
    print("RESULT" + json.dumps(out))
"""


@pytest.fixture(scope="module")
def made(tmp_path_factory):
    where = tmp_path_factory.mktemp("tables")
    for name, some in TABLES.items():
        duckdb.sql(f"COPY (SELECT * FROM '/root/testdata/sf0.001/{name}.parquet' WHERE {some}) TO '{where}/{name}.parquet' (FORMAT parquet)")
    # a session of its own, started elsewhere, so that neither its path nor its folder has the package
    import os
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", textwrap.dedent(RUN), str(ROOT), str(where)], cwd=where, env=env, capture_output=True, text=True, timeout=900)
    lines = [x for x in done.stdout.splitlines() if x.startswith("RESULT")]
    assert lines, done.stderr[-3000:]
    n = {t: duckdb.sql(f"SELECT count(*) FROM '{where}/{t}.parquet'").fetchall()[0][0] for t in TABLES}
    return json.loads(lines[0][len("RESULT"):]), n


def test_workers_lack_the_package(made):
    assert made[0]["lacking"]


@pytest.mark.parametrize("name,table,columns", [
    ("op1_embedding_dedup", "embeddings", "vec_id n_links component_id kept"),
    ("op2_licenses", "documents", "doc_id n_blocks n_found licenses found"),
    ("op3_exact_dedup", "documents", "doc_id keep_id group_size kept text_sha256"),
    ("op4_url_filter", "pages", "page_id host path rule verdict"),
    ("op5_mixing", "documents", "doc_id size source_size target taken"),
    ("op6_bloom_lm", "documents", "doc_id held_out n_tokens n_known train_tokens base_score score"),
    ("op7_importance", "documents", "doc_id log_importance key kept"),
    ("op8_suffix_dedup", "documents", "doc_id n_bytes n_removed n_spans kept_sha256"),
    ("op9_ngram_join", "documents", "doc_id n_shingles component_id"),
    ("op10_bpe", "documents", "doc_id n_tokens ids_sha256 decoded_sha256"),
    ("op11_prefix_trie", None, "conv_id depth parent_conv_id n_convs n_children n_leaves saved_tokens ends_sha256"),
    ("op12_token_align", "documents", "doc_id n_a n_b n_groups n_links n_best count_sum groups_sha256"),
    ("op13_secrets", "documents", "doc_id n_assign n_access n_hex base_sha256 spans n_random"),
    ("pipeline", None, "doc_id n_tokens ids_sha256 decoded_sha256 ids"),
])
def test_query(made, name, table, columns):
    """One row per row of its table, and the columns of its contract."""
    rows, got = made[0][name]
    assert set(columns.split()) <= set(got)
    assert rows == made[1][table] if table else rows > 0
