"""The registered queries: against their SQL, and over the given tables."""

import os

import pytest

from fareflow.llm.queries import llm_oracles, llm_queries

FOLDER = "/root/testdata/sf0.001"
TABLES = "documents pages benchmark labels conversations".split()
duckdb = pytest.importorskip("duckdb")
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


@pytest.fixture(scope="module")
def database():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    yield connection
    connection.close()


@pytest.mark.parametrize("name", sorted(llm_oracles()))
def test_query_matches_sql(spark, database, name):
    df = llm_queries()[name](spark, FOLDER)
    result = database.execute(llm_oracles()[name])
    names = [d[0] for d in result.description]
    assert sorted(df.columns) == sorted(names)
    assert sorted(map(tuple, df.select(names).collect())) == sorted(result.fetchall())
