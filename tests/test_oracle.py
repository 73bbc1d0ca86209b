"""Every registered query against its DuckDB oracle (small scale)."""

import duckdb
import pytest

import __spark_entry__ as entry
from conftest import SF_SMALL
from tools.check_oracle import TABLES, digest
from voronoi import catalog

QUERIES = entry.queries()
SQL = entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def test_every_query_has_an_oracle():
    assert set(catalog.QUERIES) <= set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF_SMALL)
    rows = [tuple(r) for r in df.collect()]
    rel = con.sql(SQL[name])
    orows = rel.fetchall()
    assert sorted(df.columns) == sorted(rel.columns)
    assert len(rows) == len(orows)
    assert digest(rows, df.columns)[0] == digest(orows, rel.columns)[0]


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["cluster_id", "n_points"]
    assert sum(r.n_points for r in df.collect()) == 500
