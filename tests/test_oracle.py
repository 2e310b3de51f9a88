"""Every registered query against its DuckDB SQL on the sf0.001 tables
(the driver runs the same check at sf0.01)."""

import duckdb
import pytest

import __spark_entry__ as E
from oracle_check import compare
from retort.session import TABLES

QUERIES = E.queries()
SQL = E.oracle_sql()


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    yield con
    con.close()


def test_every_oracle_has_a_query():
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_duckdb(spark, duck, sf_dir, name):
    df = QUERIES[name](spark, sf_dir)
    rows = [tuple(r) for r in df.collect()]
    res = duck.execute(SQL[name])
    dcols = [d[0] for d in res.description]
    assert compare(rows, df.columns, res.fetchall(), dcols) == "ok"


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_rows_only_queries_run(spark, sf_dir, name):
    df = QUERIES[name](spark, sf_dir)
    assert df.count() > 0
    assert df.columns


def test_entry_schema_is_stable(spark):
    df = E.entry(spark)
    assert df.schema.simpleString() == "struct<tag:string,n:bigint>"
    rows = df.collect()
    assert 0 < len(rows) <= 10
    counts = [r.n for r in rows]
    assert counts == sorted(counts, reverse=True)
