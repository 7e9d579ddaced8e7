"""Every registered query that has SQL, against DuckDB on the smallest tables; and the entry module itself."""

from __future__ import annotations

import math
import os

import pytest

import __spark_entry__ as entry

TABLES = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(TABLES), reason="the test tables are not here")


def _plain(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return "null"
    if hasattr(v, "isoformat"):
        return "null" if str(v) == "NaT" else str(v)[:26]
    return f"{v + 0.0:.9g}" if isinstance(v, float) else str(v)


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_equals_its_sql(spark, name):
    import duckdb

    con = duckdb.connect()
    for f in os.listdir(TABLES):
        con.execute(f"create view {f.removesuffix('.parquet')} as select * from '{TABLES}/{f}'")
    got, want = entry.queries()[name](spark, TABLES).toPandas(), con.execute(entry.oracle_sql()[name]).df()
    cols = sorted(got.columns)
    assert cols == sorted(want.columns)
    as_rows = lambda d: sorted(tuple(_plain(v) for v in r) for r in d[cols].itertuples(index=False))
    assert as_rows(got) == as_rows(want)


def test_entry_runs(spark):
    assert entry.entry(spark).count() > 0


def test_queries_without_sql_run(spark):
    for name in sorted(set(entry.queries()) - set(entry.oracle_sql())):
        if not name.startswith("op") and name != "pipeline":
            assert entry.queries()[name](spark, TABLES).count() > 0, name
