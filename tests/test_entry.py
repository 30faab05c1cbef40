"""Driver contract: entry smoke, registry/oracle keys, oracle parity at sf0.001."""

from __future__ import annotations

import duckdb
import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"
TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()
QUICK = ["customer_features", "deal_metrics", "interaction_metrics", "sales_summary",
         "channel_performance", "eda_customer_features", "descriptive_stats", "train_test_split",
         "channel_response_time", "rule_classifier_report"]


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() == 150
    assert "lead_score" in df.columns


def test_every_library_query_has_sql():
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    assert {k for k in set(q) - set(o) if not k.startswith("op") and k != "pipeline"} == set()


@pytest.mark.parametrize("name", QUICK)
def test_oracle_parity(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    s = E.queries()[name](spark, SF).toPandas()
    d = con.sql(E.oracle_sql()[name]).df()
    assert sorted(s.columns) == sorted(d.columns)
    cols = sorted(s.columns)
    key = lambda r: tuple((x is None, str(x)) for x in r)
    norm = lambda df: sorted(
        [tuple(None if (v is None or v != v) else (v.item() if hasattr(v, "item") else v) for v in r)
         for r in df[cols].astype(object).itertuples(index=False)], key=key)
    assert norm(s) == norm(d)
