"""Documented-only operators on the sample, against hand-computed values."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from dealspark.functions.scoring import recency_engagement
from dealspark.operators import aggregate as agg
from dealspark.operators import dedupe as dd
from dealspark.operators import features as ft
from dealspark.operators import topk

AS_OF = dt.date(2024, 12, 1)


@pytest.fixture(scope="module")
def features(clean):
    return ft.customer_features(clean["customers"], clean["interactions"], clean["leads"], AS_OF).cache()


def test_recency_engagement(features):
    r = features.where("customer_id = 'C001'").select(F.round(recency_engagement(
        "num_positive_outcomes", "num_calls", "total_interactions", "days_since_last_interaction"), 4)
        .alias("e")).first()
    # ((3/3)*5 + (2/3)*2 + 10*3) / 10, last contact 6 days before the reporting date
    assert r.e == 3.6333


def test_channel_conversion(clean):
    got = {r.channel_standardized: r for r in ft.channel_conversion(clean["interactions"], clean["leads"]).collect()}
    call = got["call"]
    assert (call.customers_with_deals, call.won, call.lost) == (9, 6, 2)
    assert call.channel_conversion_rate == 0.75
    assert call.avg_deal_value == round(1_537_000 / 11, 2)


def test_channel_response_time(clean):
    leads = clean["leads"].where("customer_id = 'C001'")
    inter = clean["interactions"].where("customer_id = 'C001'")
    got = {r.channel_standardized: r for r in ft.channel_response_time(inter, leads).collect()}
    # leads on 10-15 and 11-10; calls on 11-20 and 11-25; e-mail on 11-18
    assert (got["call"].leads_answered, got["call"].avg_response_days) == (2, (36 + 10) / 2)
    assert (got["email"].leads_answered, got["email"].avg_response_days) == (2, (34 + 8) / 2)


def test_daily_trend(clean):
    rows = ft.daily_trend(agg.sales_summary(clean["leads"])).orderBy("deal_date").collect()
    assert len(rows) == 15
    assert rows[0].revenue_change is None and rows[0].deals_change is None
    # 2024-06-15 won 220,000; 2024-07-01 won 550,000
    assert (rows[0].revenue_won, rows[1].revenue_won, rows[1].revenue_change) == (220_000, 550_000, 330_000)
    assert all(r.deals_change == 0 for r in rows[1:])


def test_composite_dedupe(spark, clean):
    extra = spark.createDataFrame(
        [("INT999", "C001", "call", dt.datetime(2024, 11, 20), 5, "neutral", "", "call")],
        clean["interactions"].schema)
    out = dd.keep_first(clean["interactions"].unionByName(extra), ["customer_id", "interaction_date"])
    assert out.count() == 25
    kept = out.where("customer_id = 'C001' AND interaction_date = '2024-11-20'").first()
    assert kept.interaction_id == "INT001"  # first in the declared order (id ascending)


def test_lead_features_and_hot_leads(spark, clean, features):
    lf = {r.lead_id: r for r in ft.lead_features(clean["leads"], clean["interactions"], AS_OF).collect()}
    assert len(lf) == 15
    assert (lf["L010"].customer_id, lf["L010"].engagement_score, lf["L010"].preferred_channel) == ("C009", 8.0, "call")
    hot = topk.hot_leads(spark, features, 10).collect()
    assert [(r.customer_id, r.lead_score) for r in hot] == [("C007", 100.0), ("C013", 97.98)]
