"""Analysis-rule features against the committed feature file, and the
published report anchors."""

from __future__ import annotations

import pytest

from dealspark.operators import features as ft
from dealspark.operators import profile as pf
from dealspark.operators import topk
from dealspark.plans import layered

# Committed feature rows (id n avg_duration call email whatsapp
# neg neu pos revenue deals avg_deal won engagement score quality).
GOLDEN = """
C001 3 9.0 2 1 0 0 0 3 85000 2 42500.0 2 9.0 100.0 hot
C002 3 17.666666666666668 2 0 1 0 0 3 140000 2 70000.0 2 9.0 100.0 hot
C003 2 10.0 1 1 0 1 1 0 120000 1 120000.0 0 -0.3333333333333333 31.666666666666668 cold
C004 2 6.0 0 1 1 0 0 2 45000 1 45000.0 0 8.0 100.0 hot
C005 3 13.333333333333334 1 1 1 0 0 3 200000 1 200000.0 0 9.0 100.0 hot
C006 1 0.0 0 1 0 0 0 1 15000 1 15000.0 0 6.0 100.0 hot
C007 2 22.5 1 1 0 0 0 2 550000 1 550000.0 1 8.0 100.0 hot
C008 2 10.0 1 1 0 1 1 0 85000 1 85000.0 0 -0.3333333333333333 21.166666666666668 cold
C009 2 10.0 1 0 1 0 0 2 95000 1 95000.0 0 8.0 100.0 hot
C010 1 0.0 0 1 0 0 0 1 160000 1 160000.0 0 6.0 100.0 hot
C011 1 18.0 1 0 0 0 0 1 42000 1 42000.0 0 6.0 100.0 hot
C012 1 0.0 0 1 0 0 0 1 180000 1 180000.0 0 6.0 100.0 hot
C013 2 17.5 1 1 0 0 0 2 220000 1 220000.0 1 8.0 100.0 hot
"""


@pytest.fixture(scope="module")
def eda(clean):
    return ft.eda_customer_features(clean["customers"], clean["interactions"], clean["leads"]).cache()


def test_golden_file(eda):
    got = {r.customer_id: r for r in eda.collect()}
    assert len(got) == 13
    for line in GOLDEN.strip().splitlines():
        (cid, n, dur, call, email, wa, neg, neu, pos, rev, deals, avgd, won, eng, score, q) = line.split()
        r = got[cid]
        assert (r.total_interactions, r.num_call, r.num_email, r.num_whatsapp) == (
            int(n), int(call), int(email), int(wa)), cid
        assert (r.num_negative_outcomes, r.num_neutral_outcomes, r.num_positive_outcomes) == (
            int(neg), int(neu), int(pos)), cid
        assert (r.total_revenue, r.total_deals, r.num_closed_won) == (float(rev), int(deals), int(won)), cid
        for got_v, want in ((r.avg_interaction_duration, dur), (r.avg_deal_value, avgd),
                            (r.engagement_score, eng), (r.lead_score, score)):
            assert abs(got_v - float(want)) <= 1e-9, cid
        assert r.lead_quality == q, cid


def test_eda_band_edges(spark):
    from dealspark.functions.scoring import quality_band
    from dealspark.plans.profiles import EDA
    s = spark.createDataFrame([(80.0,), (60.0,), (40.0,), (0.0,), (100.0,)], "s double")
    assert [r.q for r in s.select(quality_band("s", EDA).alias("q")).collect()] == [
        "warm", "cool", "cold", None, "hot"]


def test_report_anchors(clean, eda):
    rep = layered.analysis_report(clean["customers"], clean["leads"], clean["interactions"],
                                    clean["products"], eda)
    v = {(r.section, r.metric, r.dimension): r.value for r in rep.collect()}
    assert v[("summary", "total_customers", "")] == 13
    assert v[("summary", "total_leads", "")] == 15
    assert v[("summary", "total_interactions", "")] == 25
    assert v[("summary", "total_products", "")] == 8
    assert v[("leads", "sum_deal_value", "")] == 1_937_000
    assert round(v[("leads", "mean_deal_value", "")]) == 129_133
    assert v[("leads", "median_deal_value", "")] == 85_000
    assert (v[("leads", "status_deals", "open")], v[("leads", "status_deal_value", "open")]) == (7, 737_000)
    assert (v[("leads", "status_deals", "closed_won")], v[("leads", "status_deal_value", "closed_won")]) == (6, 995_000)
    assert (v[("leads", "status_deals", "closed_lost")], v[("leads", "status_deal_value", "closed_lost")]) == (2, 205_000)
    assert v[("customers", "sum_annual_revenue", "")] == 1_299_500_000
    assert round(v[("customers", "mean_employee_count", "")]) == 1000
    assert (v[("customers", "max_employee_count", "")], v[("customers", "min_employee_count", "")]) == (5000, 45)
    assert round(v[("interactions", "mean_duration_minutes", "")], 1) == 11.6
    assert [v[("interactions", "channel_interactions", c)] for c in ("call", "email", "whatsapp")] == [11, 10, 4]
    assert [v[("interactions", "outcome_interactions", c)] for c in ("positive", "negative", "neutral")] == [21, 2, 2]
    assert round(v[("features", "mean_lead_score", "")], 1) == 88.7
    assert v[("features", "median_lead_score", "")] == 100.0
    assert v[("features", "max_lead_score", "")] == 100.0
    assert [v[("features", "quality_customers", q)] for q in ("hot", "warm", "cool", "cold")] == [11, 0, 0, 2]
    assert round(v[("features", "mean_engagement_score", "")], 1) == 6.3
    assert round(v[("features", "mean_total_interactions", "")], 1) == 1.9
    assert round(v[("features", "mean_total_revenue", "")]) == 149_000


def test_top_lists(eda, clean):
    top = topk.top_by_revenue_ascending(eda, 10).collect()
    assert top[-1].total_revenue == 550_000 and len(top) == 10
    assert [r.total_revenue for r in top] == sorted(r.total_revenue for r in top)
    ranked = topk.top_by_lead_score(eda, 10).collect()
    assert [r["rank"] for r in ranked] == list(range(1, 11))
    ind = pf.top_values(clean["customers"], "industry", 5).collect()
    assert (ind[0].value, ind[0]["count"]) == ("Technology", 3)
    assert abs(ind[0].pct - 300 / 13) < 1e-12 and len(ind) == 5


def test_histogram_and_median(spark, eda):
    h = pf.score_histogram(eda, "lead_score", 15).collect()
    assert len(h) == 15 and sum(r.customers for r in h) == 13
    assert h[-1].customers == 11 and h[0].customers == 1
    m = pf.exact_median(spark.createDataFrame([(float(x),) for x in [5, 1, 3, 2]], "x double"), "x")
    assert m.first().median == 2.5
    assert pf.exact_median(spark.createDataFrame([], "x double"), "x").first().median is None


def test_null_profile_and_distribution(raw, clean):
    nulls = {(r.column_name): r.null_count for r in pf.null_profile(raw["leads"], "leads").collect()}
    assert nulls == {"email": 1, "phone": 2}
    dist = pf.most_frequent_first(pf.value_distribution(clean["leads"], "status")).collect()
    assert [(r.value, r["count"]) for r in dist] == [("open", 7), ("closed_won", 6), ("closed_lost", 2)]
    assert abs(sum(r.pct for r in dist) - 100.0) < 1e-9


def test_column_stats_industry_revenue_points(clean):
    s = pf.column_stats(clean["leads"], "leads", ["deal_value"]).first()
    assert (s.min_value, s.max_value, s.sum_value) == (15_000.0, 550_000.0, 1_937_000.0)
    assert abs(s.mean_value - 1_937_000 / 15) < 1e-9
    ind = pf.sum_by(clean["customers"], "industry", "annual_revenue", "annual_revenue").collect()
    assert (ind[0].industry, ind[0].annual_revenue) == ("Technology", 624_500_000.0)
    pts = pf.scatter_points(clean["customers"], "customer_id", "employee_count", "annual_revenue")
    assert pts.columns == ["customer_id", "employee_count", "annual_revenue"] and pts.count() == 13


def test_exact_medians_with_a_hot_value(spark):
    import numpy as np
    rng = np.random.default_rng(7)
    a = rng.normal(50, 10, 20_000).round(3)
    a[: len(a) // 3] = 42.0  # one value holds a third of the rows
    b = rng.integers(0, 1000, 20_000).astype(float)
    df = spark.createDataFrame([(float(x), float(y)) for x, y in zip(a, b)], "a double, b double")
    got = {r.column_name: r.median for r in pf.exact_medians(df, ["a", "b"]).collect()}
    assert got == {"a": float(np.median(a)), "b": float(np.median(b))}
    nulls = spark.createDataFrame([(None,), (None,)], "a double")
    assert pf.exact_median(nulls, "a").first().median is None
