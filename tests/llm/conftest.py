import duckdb
import pytest

TABLES = ["documents", "benchmark", "embeddings", "labels"]


@pytest.fixture(scope="session")
def against_sql(spark, sf_dir):
    """Runs a registered query and its SQL and compares all rows."""
    from cytospark.llm.queries import QUERIES, SQL

    def run(name):
        base = duckdb.connect()
        for t in TABLES:
            base.sql(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
        want = base.sql(SQL[name])
        names = sorted(want.columns)
        order = [want.columns.index(n) for n in names]
        expected = sorted(tuple(r[i] for i in order) for r in want.fetchall())
        got = QUERIES[name](spark, sf_dir).select(*names)
        assert sorted(map(tuple, got.collect())) == expected
    return run
