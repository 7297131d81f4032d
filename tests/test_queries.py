"""Every registered query against its SQL, on the smallest tables."""

from __future__ import annotations

import duckdb
import pytest

import __spark_entry__ as entry
from checks.compare import compare

DIR = "/root/testdata/sf0.001"
SQL = entry.oracle_sql()
RUNS = entry.queries()


@pytest.mark.parametrize("name", list(RUNS))
def test_query(spark, name):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    out = compare(spark, con, DIR, name, RUNS[name], SQL.get(name))
    assert out.startswith(("ok", "rows-only")), out


def test_entry_gives_rows(spark):
    assert entry.entry(spark).count() > 0
