"""Every registered query with SQL gives what DuckDB gives."""

import datetime
import decimal

import pytest

from tidemark.plans import registry

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def plain(v):
    return str(v) if isinstance(v, decimal.Decimal) else v.isoformat() if isinstance(v, datetime.datetime) else v


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_query(spark, duck, name):
    df = registry.queries()[name](spark, SF)
    cols = sorted(df.columns)
    got = sorted((tuple(plain(r[c]) for c in cols) for r in df.collect()), key=str)
    res = duck.execute(registry.oracle_sql()[name])
    names = [d[0] for d in res.description]
    assert sorted(names) == cols
    at = [names.index(c) for c in cols]
    assert got == sorted((tuple(plain(r[i]) for i in at) for r in res.fetchall()), key=str)


@pytest.mark.parametrize("name", sorted(set(registry.queries()) - set(registry.oracle_sql())))
def test_query_without_sql(spark, name):
    """Those that learn: their rows are there, with the columns that they say."""
    df = registry.queries()[name](spark, SF)
    rows = df.collect()
    assert rows and len(df.columns) == len(set(df.columns))


def test_entry_imports():
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())
