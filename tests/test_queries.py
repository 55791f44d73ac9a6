"""Every registered query against its SQL in another engine."""

import duckdb
import pytest

from __spark_entry__ import oracle_sql, queries
from cytospark.plans import catalog

catalog.load()
TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
    "embeddings", "pages", "benchmark", "labels", "conversations",
]


@pytest.fixture(scope="module")
def engine(sf_dir):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def rows(columns, data):
    order = [columns.index(c) for c in sorted(columns)]
    return sorted((tuple(r[i] for i in order) for r in data), key=repr)


@pytest.mark.parametrize("name", sorted(catalog.SQL))
def test_same_rows_as_sql(spark, sf_dir, engine, name):
    df = queries()[name](spark, sf_dir)
    found = engine.sql(oracle_sql()[name])
    assert sorted(df.columns) == sorted(found.columns)
    assert rows(df.columns, df.collect()) == rows(list(found.columns), found.fetchall())


@pytest.mark.parametrize("name", sorted(set(catalog.QUERIES) - set(catalog.SQL)))
def test_runs_without_sql(spark, sf_dir, name):
    assert queries()[name](spark, sf_dir).count() > 0


def test_every_sql_has_a_query():
    assert set(oracle_sql()) <= set(queries())
