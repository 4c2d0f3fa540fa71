"""Every registered retail query against its SQL, on the smallest tables."""

import datetime as dt
import decimal

import duckdb
import pytest

from stallmark.plans import queries as retail

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck(sf):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    return con


def plain(v):
    if isinstance(v, (float, decimal.Decimal)):
        return f"{float(v):.6g}"
    if isinstance(v, dt.datetime) and v.time() == dt.time():
        return str(v.date())
    return str(v)


@pytest.mark.parametrize("name", sorted(retail.oracle_sql()))
def test_against_sql(spark, sf, duck, name):
    df = retail.queries()[name](spark, sf)
    columns = sorted(df.columns)
    got = sorted(tuple(plain(r[c]) for c in columns) for r in df.collect())
    res = duck.execute(retail.oracle_sql()[name])
    names = [d[0] for d in res.description]
    assert sorted(names) == columns
    at = [names.index(c) for c in columns]
    assert got == sorted(tuple(plain(r[k]) for k in at) for r in res.fetchall())


@pytest.mark.parametrize("name", sorted(set(retail.queries()) - set(retail.oracle_sql())))
def test_checks_pass(spark, sf, name):
    assert retail.queries()[name](spark, sf).count() == 0


def test_names():
    assert set(retail.oracle_sql()) <= set(retail.queries())
