"""The driver's contract, and every query with SQL against DuckDB on the smallest tables."""

import datetime
import decimal
import math
from collections import Counter
from pathlib import Path

import pytest

import __spark_entry__ as entry
from factloom.plans import registry


def _plain(v):
    if v is None or isinstance(v, float) and math.isnan(v):
        return None
    if isinstance(v, (float, decimal.Decimal)) or isinstance(v, int) and not isinstance(v, bool):
        return float(f"{float(v):.9g}")
    return v.replace(tzinfo=None).isoformat() if isinstance(v, datetime.datetime) else v


@pytest.fixture(scope="module")
def duck(data):
    import duckdb

    con = duckdb.connect()
    for f in Path(data).glob("*.parquet"):
        con.execute(f"create view {f.stem} as select * from '{f}'")
    return con


@pytest.mark.parametrize("name", sorted(registry.ORACLES))
def test_query_equals_sql(spark, data, duck, name):
    df = entry.queries()[name](spark, data)
    got = Counter(str([_plain(r[c]) for c in sorted(df.columns)]) for r in df.collect())
    result = duck.execute(entry.oracle_sql()[name])
    names = [c[0] for c in result.description]
    assert sorted(names) == sorted(df.columns)
    want = Counter(str([_plain(r[names.index(c)]) for c in sorted(names)]) for r in result.fetchall())
    assert got == want


@pytest.mark.parametrize("name", sorted(set(registry.QUERIES) - set(registry.ORACLES)))
def test_query_runs(spark, data, name):
    df = entry.queries()[name](spark, data)
    assert df.count() >= 0 and df.columns


def test_names():
    assert set(entry.oracle_sql()) <= set(entry.queries())
