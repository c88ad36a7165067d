"""Every registered query equals its DuckDB oracle (row count, columns, values) at sf0.001."""
import os

import pytest

import __spark_entry__ as E
from tools.check_oracle import digest

from chartfold.queries import registry

QUERIES = {k: v for k, v in E.queries().items() if k in registry()}
ORACLES = E.oracle_sql()


def test_every_query_has_an_oracle():
    assert set(QUERIES) <= set(ORACLES)


@pytest.fixture(scope="module")
def duck(small_dir):
    import duckdb
    con = duckdb.connect()
    for t in ("region nation customer supplier part orders lineitem events documents embeddings pages "
              "benchmark labels conversations").split():
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{small_dir}/{t}.parquet')")
    yield con
    con.close()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, small_dir, name):
    df = QUERIES[name](spark, small_dir)
    s_rows = [tuple(r) for r in df.collect()]
    res = duck.execute(ORACLES[name])
    o_cols = [d[0] for d in res.description]
    o_rows = res.fetchall()
    assert sorted(df.columns) == sorted(o_cols)
    assert len(s_rows) == len(o_rows)
    assert digest(df.columns, s_rows)[0] == digest(o_cols, o_rows)[0]


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0 and "date_created" in df.columns
