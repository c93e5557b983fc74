"""Driver contract: entry, queries and oracles line up and agree."""

import duckdb
import pytest

import __spark_entry__ as E
from check_oracles import TABLES, compare

SF = "/root/testdata/sf0.001"


def test_entry_runs(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert df.columns == ["rating", "n"]


def test_every_query_has_an_oracle():
    assert set(E.oracle_sql()) <= set(E.queries())
    assert set(E.queries()) - set(E.oracle_sql()) <= E.LLM_QUERIES


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"create view {t} as select * from read_parquet('{SF}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(set(E.oracle_sql()) - E.LLM_QUERIES))
def test_query_matches_oracle(spark, con, name):
    res = compare(spark, con, name, SF)
    assert res["columns_match"], res
    assert res["match"], res
