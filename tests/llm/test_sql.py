"""The queries that SQL can express, against their DuckDB SQL on whole tables."""

from __future__ import annotations

import duckdb
import pytest

import __spark_entry__ as entry
from dealspark.llm.sql import SQL

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(SQL))
def test_parity(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "labels"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    made = entry.queries()[name](spark, SF)
    columns = sorted(made.columns)
    want = con.sql(entry.oracle_sql()[name])
    assert sorted(want.columns) == columns
    rows = want.project(", ".join(columns)).fetchall()
    assert sorted(map(str, (tuple(r) for r in made.select(*columns).collect()))) == sorted(map(str, rows))
