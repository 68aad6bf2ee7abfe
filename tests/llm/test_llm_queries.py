"""The corpus queries, and their SQL where there is any."""

import pytest

import __spark_entry__ as entry
from factloom.llm import oracles, queries


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_query_runs(spark, data, name):
    assert entry.queries()[name](spark, data).count() >= 0


def test_sql(spark, data):
    import duckdb

    con = duckdb.connect()
    for t in ("filing_info", "capture_channels", "sections"):
        con.execute(f"create view {t} as select * from '{data}/{t}.parquet'")
    for name, sql in oracles.ORACLES.items():
        df = entry.queries()[name](spark, data)
        assert sorted(map(str, map(tuple, df.select(*sorted(df.columns)).collect()))) == sorted(map(str, con.execute(f"select {', '.join(sorted(df.columns))} from ({sql})").fetchall()))
