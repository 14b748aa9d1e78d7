"""Driver contract: entry(), queries() and oracle_sql() on the smallest data."""

import duckdb
import pytest

import __spark_entry__ as E
from dqspark.sources.tables import TABLES
from tests.conftest import SF_SMALL

LLM = set(E.llm.QUERIES) if E.llm else set()      # tested in tests/llm

QUERIES = [n for n in E.queries() if n not in LLM]


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["ord", "metric", "before", "after"]
    assert df.count() == 10


def test_every_query_has_an_oracle():
    assert set(E.oracle_sql()) <= set(E.queries())
    assert set(QUERIES) <= set(E.oracle_sql())


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", QUERIES)
def test_query_matches_oracle(spark, duck, name):
    from tools.check_oracle import digest
    sdf = E.queries()[name](spark, SF_SMALL)
    rel = duck.sql(E.oracle_sql()[name])
    s_rows, d_rows = [tuple(r) for r in sdf.collect()], rel.fetchall()
    assert sorted(sdf.columns) == sorted(rel.columns)
    assert digest(sdf.columns, s_rows)[0] == digest(rel.columns, d_rows)[0]
