"""Text queries next to their SQL twins on the smallest tables."""

import duckdb
import pytest

from txlens.llm.queries import QUERIES
from txlens.llm.twins import SQL

TABLES = ("documents", "pages", "benchmark", "labels", "conversations")


def _ordered(names, rows):
    places = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(r[i] for i in places) for r in rows), key=lambda r: tuple((v is None, str(v)) for v in r))


@pytest.fixture(scope="module")
def duck(small):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{small}/{name}.parquet')")
    return connection


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_agrees_with_sql(spark, duck, small, name):
    frame = QUERIES[name](spark, small)
    result = duck.execute(SQL[name])
    names = [c[0] for c in result.description]
    assert sorted(frame.columns) == sorted(names)
    got, expected = _ordered(frame.columns, frame.collect()), _ordered(names, result.fetchall())
    assert got and got == expected
