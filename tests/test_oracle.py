"""Every registered query against its DuckDB SQL on the smallest test data."""

import datetime as dt
import hashlib

import duckdb
import pytest

import __spark_entry__ as E
from turnstile.plans import catalog

SF = "/root/testdata/sf0.001"
NAMES = sorted(catalog.queries())


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in ("events", "customer"):
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def _digest(cols, data):
    order = sorted(range(len(cols)), key=lambda i: cols[i])

    def norm(v):
        if isinstance(v, float):
            return repr(round(v, 9))
        if isinstance(v, dt.datetime):
            return v.replace(tzinfo=None).isoformat(sep=" ")
        return "NULL" if v is None else str(v)

    lines = sorted("|".join(norm(r[i]) for i in order) for r in data)
    return hashlib.sha256("\n".join(lines).encode()).hexdigest()


def test_every_query_has_oracle():
    assert set(catalog.oracle_sql()) == set(catalog.queries())
    assert set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_duckdb(spark, con, name):
    df = E.queries()[name](spark, SF)
    got = [tuple(r) for r in df.collect()]
    res = con.execute(E.oracle_sql()[name])
    cols = [d[0] for d in res.description]
    want = res.fetchall()
    assert sorted(df.columns) == sorted(cols)
    assert len(got) == len(want)
    assert _digest(df.columns, got) == _digest(cols, want)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["record_date", "record_hour", "total_hourly_entries", "total_hourly_exits"]
