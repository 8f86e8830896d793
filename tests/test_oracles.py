"""Every registered query against its SQL on DuckDB."""

import math
import os

import pytest

from __spark_entry__ import entry
from registry.fare_queries import fare_queries
from registry.fare_sql import fare_oracles
from registry.table_queries import table_queries
from registry.table_sql import table_oracles

FOLDER = "/root/testdata/sf0.001"
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()
duckdb = pytest.importorskip("duckdb")
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


def queries():
    return {**fare_queries(), **table_queries()}


def oracle_sql():
    return {**fare_oracles(), **table_oracles()}


@pytest.fixture(scope="module")
def database():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    yield connection
    connection.close()


def _plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 6)
    if isinstance(value, (list, tuple)):
        return tuple(_plain(v) for v in value)
    return value


def _table(names, data):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], sorted(
        (tuple(_plain(row[i]) for i in order) for row in data), key=repr)


def test_every_query_has_sql():
    assert set(queries()) == set(oracle_sql())


@pytest.mark.parametrize("name", sorted(queries()))
def test_query_matches_sql(spark, database, name):
    df = queries()[name](spark, FOLDER)
    result = database.execute(oracle_sql()[name])
    names = [d[0] for d in result.description]
    assert _table(df.columns, df.collect()) == _table(names, result.fetchall())


def test_entry(spark):
    assert entry(spark).count() > 0
