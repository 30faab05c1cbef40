"""Notebook-rule customer features against the hand-evaluated golden table."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from dealspark.operators import aggregate as agg
from dealspark.operators import features as ft
from dealspark.operators import topk

AS_OF = dt.date(2024, 12, 1)

# Expected features (id n call wa email pos neg eng preferred
# last revenue won lost open cr wr avg_deal score quality p).
GOLDEN = """
C001 3 2 0 1 3 0 9.0 call 2024-11-25 85000 2 0 0 0.9995 0.9995 42478.76 60.49 warm 0.6357
C002 3 2 1 0 3 0 9.0 call 2024-11-20 140000 2 0 0 0.9995 0.9995 69965.02 76.99 warm 0.6357
C003 2 1 0 1 0 1 -0.33 call 2024-11-10 0 0 1 0 0.0 0.0 119880.12 3.67 cold -0.0013
C004 2 0 1 1 2 0 8.0 whatsapp 2024-11-22 0 0 0 1 0.0 0.0 44955.04 12.0 cold 0.032
C005 3 1 1 1 3 0 9.0 call 2024-11-25 0 0 0 1 0.0 0.0 199800.2 15.0 cold 0.036
C006 1 0 0 1 1 0 6.0 email 2024-11-24 0 0 0 1 0.0 0.0 14985.01 8.0 cold 0.024
C007 2 1 0 1 2 0 8.0 call 2024-11-20 550000 1 0 0 0.999 0.999 549450.55 100.0 hot 0.6314
C008 2 1 0 1 0 1 -0.33 call 2024-11-19 0 0 1 0 0.0 0.0 84915.08 3.67 cold -0.0013
C009 2 1 1 0 2 0 8.0 call 2024-11-23 0 0 0 1 0.0 0.0 94905.09 12.0 cold 0.032
C010 1 0 0 1 1 0 6.0 email 2024-11-25 0 0 0 1 0.0 0.0 159840.16 8.0 cold 0.024
C011 1 1 0 0 1 0 6.0 call 2024-11-24 0 0 0 1 0.0 0.0 41958.04 8.0 cold 0.024
C012 1 0 0 1 1 0 6.0 email 2024-11-22 0 0 0 1 0.0 0.0 179820.18 8.0 cold 0.024
C013 2 1 0 1 2 0 8.0 call 2024-11-20 220000 1 0 0 0.999 0.999 219780.22 97.98 hot 0.6314
"""


@pytest.fixture(scope="module")
def features(clean):
    return ft.customer_features(clean["customers"], clean["interactions"], clean["leads"], AS_OF).cache()


def test_golden_rows(features, clean):
    im = {r.customer_id: r for r in agg.interaction_metrics(clean["interactions"], AS_OF).collect()}
    got = {r.customer_id: r for r in features.collect()}
    assert len(got) == 13
    for line in GOLDEN.strip().splitlines():
        (cid, n, call, wa, email, pos, neg, eng, pref, last, rev, won, lost, opn,
         cr, wr, avgd, score, quality, p) = line.split()
        r = got[cid]
        assert (r.total_interactions, r.num_calls, r.num_whatsapp, r.num_emails) == (
            int(n), int(call), int(wa), int(email)), cid
        assert (r.num_positive_outcomes, r.num_negative_outcomes) == (int(pos), int(neg)), cid
        assert r.engagement_score == float(eng), cid
        assert r.preferred_channel == pref, cid
        assert im[cid].last_interaction_date.date().isoformat() == last, cid
        assert r.total_revenue == float(rev), cid
        assert (r.num_closed_won, r.num_closed_lost, r.num_open_deals) == (int(won), int(lost), int(opn)), cid
        assert (r.conversion_rate, r.win_rate, r.avg_deal_value) == (float(cr), float(wr), float(avgd)), cid
        assert r.lead_score == float(score), cid
        assert r.lead_quality == quality, cid
        assert r.probability_to_convert == float(p), cid


def test_aggregate_anchors(features):
    dist = {r.lead_quality: r["count"] for r in features.groupBy("lead_quality").count().collect()}
    assert dist == {"hot": 2, "warm": 2, "cold": 9}
    row = features.agg(F.round(F.avg("lead_score"), 2).alias("m"), F.median("lead_score").alias("md")).first()
    assert (row.m, row.md) == (31.83, 12.0)
    c001 = features.where("customer_id = 'C001'").first()
    assert c001.days_since_last_interaction == 6


def test_schema_and_columns(features):
    assert len(features.columns) == 28
    assert features.columns[:9] == list(ft.CUSTOMER_COLUMNS)
    assert features.columns[-3:] == ["lead_score", "lead_quality", "probability_to_convert"]


def test_missing_customers_get_defaults(spark, clean):
    extra = spark.createDataFrame(
        [("C900", "No Contact", "X", "USA", "Y", 1, 1.0, "AM", None),
         ("C901", "No Deals", "X", "USA", "Y", 1, 1.0, "AM", None)],
        clean["customers"].schema)
    inter = clean["interactions"].unionByName(spark.createDataFrame(
        [("I901", "C901", "call", dt.datetime(2024, 11, 30), 5, "positive", "", "call"),
         ("I999", "C999", "call", dt.datetime(2024, 11, 30), 5, "positive", "", "call")],
        clean["interactions"].schema))
    f = ft.customer_features(clean["customers"].unionByName(extra), inter, clean["leads"], AS_OF)
    got = {r.customer_id: r for r in f.collect()}
    assert "C999" not in got and len(got) == 15
    c900 = got["C900"]
    assert (c900.total_interactions, c900.engagement_score, c900.preferred_channel,
            c900.days_since_last_interaction) == (0, 0.0, "email", 999)
    c901 = got["C901"]
    assert (c901.total_revenue, c901.conversion_rate, c901.win_rate, c901.avg_deal_value) == (0.0, 0.0, 0.0, 0.0)


def test_channel_ties_and_edges(spark):
    from dealspark.functions.scoring import frequency_per_day, preferred_channel, quality_band, lead_score
    df = spark.createDataFrame([(1, 1, 1), (0, 1, 1), (0, 0, 1), (0, 0, 0)], "c long, w long, e long")
    assert [r.p for r in df.select(preferred_channel("c", "w", "e").alias("p")).collect()] == [
        "call", "whatsapp", "email", "call"]
    s = spark.createDataFrame([(80.0,), (60.0,), (40.0,), (39.99,), (-5.0,)], "s double")
    assert [r.q for r in s.select(quality_band("s").alias("q")).collect()] == [
        "hot", "warm", "cool", "cold", "cold"]
    big = spark.createDataFrame([(1e6, 0, 0.0, 0.0), (0.0, 1, -3.0, 0.0)], "r double, n long, e double, w double")
    assert [r.s for r in big.select(lead_score("r", "n", "e", "w").alias("s")).collect()] == [100.0, -1.0]
    d = spark.createDataFrame([(3, dt.datetime(2024, 12, 2))], "n long, first timestamp_ntz")
    assert d.select(frequency_per_day("n", "first", AS_OF).alias("f")).first().f is None


def test_no_won_deal_gives_null_average(clean):
    dm = {r.customer_id: r for r in agg.deal_metrics(clean["leads"]).collect()}
    assert dm["C004"].avg_won_deal_value is None
    assert dm["C001"].avg_won_deal_value == 42500.0


def test_channel_performance_golden(clean):
    rows = agg.channel_performance(clean["interactions"]).collect()
    assert [r.channel_standardized for r in rows] == ["call", "email", "whatsapp"]
    got = {r.channel_standardized: r for r in rows}
    call, email, wa = got["call"], got["email"], got["whatsapp"]
    assert (call.total_interactions, call.positive_outcomes, call.negative_outcomes, call.neutral_outcomes,
            call.unique_customers, call.positive_rate, call.interactions_per_customer) == (
        11, 9, 2, 0, 9, 0.8181, 1.22)
    assert abs(call.avg_duration_minutes - 255 / 11) < 1e-12
    assert (email.total_interactions, email.neutral_outcomes, email.avg_duration_minutes,
            email.unique_customers, email.positive_rate, email.interactions_per_customer) == (
        10, 2, 0.0, 10, 0.7999, 1.0)
    assert (wa.total_interactions, wa.avg_duration_minutes, wa.positive_rate) == (4, 8.75, 0.9998)


def test_sales_summary_golden(clean):
    rows = agg.sales_summary(clean["leads"]).collect()
    assert len(rows) == 15 and all(r.total_deals == 1 for r in rows)
    dates = [r.deal_date for r in rows]
    assert dates == sorted(dates, reverse=True)
    assert dates[-1] == dt.datetime(2024, 6, 15) and dates[0] == dt.datetime(2024, 11, 12)
    assert sorted(r.win_rate_daily for r in rows) == [0.0] * 9 + [0.999] * 6
    assert sum(r.revenue_won for r in rows) == 995000.0


def test_top_customers_order(features):
    rows = topk.top_customers(features).collect()
    assert [r.customer_id for r in rows[:4]] == ["C007", "C013", "C002", "C001"]
    assert [r.customer_id for r in rows[4:]] == sorted(r.customer_id for r in rows[4:])
    assert len(rows) == 13 and len(rows[0]) == 11


def test_documented_rule_sets(features):
    from dealspark.plans.profiles import DOC_WEIGHTED
    base = features.drop("lead_score", "lead_quality", "probability_to_convert")
    w = {r.customer_id: r for r in ft.score_features(base, DOC_WEIGHTED).collect()}
    # C007 has the largest revenue (550,000) and 2 of max 3 interactions
    want = round(100 * 0.30 + (2 / 3) * 100 * 0.20 + 8.0 * 0.25 + 0.999 * 100 * 0.25, 2)
    assert w["C007"].lead_score == want
    ws = {r.customer_id: r.weighted_score for r in ft.weighted_score(features).collect()}
    assert ws["C007"] == want
