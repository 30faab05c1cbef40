"""Invariants over the benchmark tables, and a hot-key case."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from dealspark.operators import aggregate as agg
from dealspark.plans.registry import BENCH_NOTEBOOK, Tables
from dealspark.sources import driver_tables as dtab

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def t(spark):
    return Tables(spark, SF)


def test_feature_rows_equal_customers(t):
    feats = t.features()
    assert feats.count() == t.clean("customers").count()
    assert feats.where(F.col("lead_score") > 100).count() == 0
    assert feats.select("customer_id").distinct().count() == feats.count()


def test_daily_deals_sum_to_leads(t):
    daily = agg.sales_summary(t.clean("leads"), BENCH_NOTEBOOK)
    total = daily.agg(F.sum("total_deals")).first()[0]
    assert total == t.clean("leads").count()
    assert daily.where(F.col("deal_date").isNull()).count() == 1  # the injected bad dates


def test_channel_counts_sum_to_interactions(t):
    ch = agg.channel_performance(t.clean("interactions"), BENCH_NOTEBOOK)
    row = ch.agg(F.sum("total_interactions"), F.sum(F.col("positive_outcomes") + F.col("negative_outcomes")
                                                     + F.col("neutral_outcomes"))).first()
    n = t.clean("interactions").count()
    assert row[0] == n and row[1] == n


def test_dedupe_removes_injected_copies(t):
    raw, clean = t.raw("leads"), t.clean("leads")
    assert clean.count() == raw.select("lead_id").distinct().count()
    assert raw.count() - clean.count() == 75  # every 20th of 1,500 orders arrives twice
    # the kept copy is the original (smaller) deal value
    orders = dtab.load(t.spark, SF, "orders").where("o_orderkey % 20 = 0 AND o_orderkey % 50 <> 0")
    kept = clean.join(orders.select(F.col("o_orderkey").cast("string").alias("lead_id"), "o_totalprice"),
                      "lead_id")
    assert kept.where(F.col("deal_value") != F.col("o_totalprice")).count() == 0


def test_hot_customer_matches_brute_force(spark):
    """One customer holds a third of all interactions; per-customer metrics
    still equal a brute-force recount, and the plan pre-aggregates map-side."""
    n = 30_000
    rows = spark.range(n).select(
        F.col("id").cast("string").alias("interaction_id"),
        F.when(F.col("id") % 3 == 0, F.lit("HOT")).otherwise((F.col("id") % 997).cast("string")).alias("customer_id"),
        F.element_at(F.array(F.lit("call"), F.lit("email"), F.lit("whatsapp")),
                     (F.col("id") % 3 + 1).cast("int")).alias("channel_standardized"),
        F.element_at(F.array(F.lit("positive"), F.lit("negative"), F.lit("neutral")),
                     (F.col("id") % 5 % 3 + 1).cast("int")).alias("outcome"),
        (F.col("id") % 60).cast("int").alias("interaction_time_minutes"),
        F.lit(dt.datetime(2024, 1, 1)).cast("timestamp_ntz").alias("interaction_date"),
    ).repartition(8)
    im = agg.interaction_metrics(rows, dt.date(2024, 2, 1))
    hot = im.where("customer_id = 'HOT'").first()
    brute = rows.where("customer_id = 'HOT'").toPandas()
    assert hot.total_interactions == len(brute) == n // 3
    assert hot.num_positive_outcomes == int((brute.outcome == "positive").sum())
    assert hot.num_calls == int((brute.channel_standardized == "call").sum())
    plan = im._jdf.queryExecution().executedPlan().toString()
    assert "partial_count" in plan
