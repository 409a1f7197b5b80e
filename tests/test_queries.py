"""Every query with SQL must give the same rows in DuckDB."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as entry

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def db(sf):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{os.path.join(sf, name)}.parquet'")
    return con


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def value(x):
        if isinstance(x, float):
            return 0.0 if x == 0 else x
        return x

    cleaned = [tuple(value(r[i]) for i in order) for r in rows]
    return sorted(cleaned, key=lambda r: tuple((x is None, x if x is not None else 0) for x in r))


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_same_rows_as_sql(spark, db, sf, name):
    df = entry.queries()[name](spark, sf)
    result = db.execute(entry.oracle_sql()[name])
    columns = [c[0] for c in result.description]
    assert sorted(df.columns) == sorted(columns)
    got = canonical(df.columns, [tuple(r) for r in df.collect()])
    expected = canonical(columns, result.fetchall())
    assert len(got) == len(expected)
    for a, b in zip(got, expected):
        assert a == b or all(
            x == y or (isinstance(x, float) and math.isclose(x, y, abs_tol=1.1e-6))
            for x, y in zip(a, b)
        )


def test_each_sql_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry_gives_rows(spark, sf):
    df = entry.entry(spark)
    assert df.columns == ["lang", "rank", "term", "gap"]
    assert df.count() == 80
