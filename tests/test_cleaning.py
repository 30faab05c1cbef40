"""Cleaning rules on the committed sample and on dirty rows written by us."""

from __future__ import annotations

import datetime as dt
import math

from pyspark.sql import functions as F

from dealspark.operators import clean as cl
from dealspark.operators import dedupe as dd
from dealspark.schemas import clean_schema, raw_schema


def _raw(spark, entity, rows):
    cols = raw_schema(entity).fieldNames()
    full = [tuple(r.get(c) for c in cols) for r in rows]
    return spark.createDataFrame(full, raw_schema(entity))


def test_sample_schemas_and_counts(clean):
    for e, df in clean.items():
        assert [(f.name, f.dataType) for f in df.schema] == [
            (f.name, f.dataType) for f in clean_schema(e)], e
    assert {e: df.count() for e, df in clean.items()} == {
        "leads": 15, "customers": 13, "interactions": 25, "products": 8}
    leads = clean["leads"]
    assert leads.where("is_contactable = 1").count() == 15
    assert leads.where(F.col("email").isNull()).count() == 1


def test_dirty_leads(spark):
    rows = [
        dict(lead_id="A1", status=" Closed_Won ", email=" A@B.COM ", deal_value="n/a", created_at="2024/13/45"),
        dict(lead_id="A2", status="open", deal_value="", created_at="2024-1-5", phone="  "),
        dict(lead_id="A3", status="open", deal_value="NaN", created_at="2024-02-30"),
        dict(lead_id="A4", deal_value="12.5", created_at="2024-02-29", email="x@y.z"),
    ]
    got = {r.lead_id: r for r in cl.clean_leads(_raw(spark, "leads", rows)).collect()}
    a1, a2, a3, a4 = got["A1"], got["A2"], got["A3"], got["A4"]
    assert (a1.status, a1.email, a1.deal_value, a1.created_at) == ("closed_won", "a@b.com", 0.0, None)
    assert (a1.is_contactable, a2.is_contactable, a3.is_contactable) == (1, 1, 0)
    assert (a2.deal_value, a2.created_at) == (0.0, None)
    assert math.isnan(a3.deal_value) and a3.created_at is None
    assert (a4.deal_value, a4.created_at) == (12.5, dt.datetime(2024, 2, 29))


def test_dirty_customers_and_interactions(spark):
    cust = [dict(customer_id="C1", employee_count="12x"), dict(customer_id="C2", employee_count="12.7"),
            dict(customer_id="C3", employee_count="1e3"), dict(customer_id="C4", employee_count=" 42 ")]
    got = {r.customer_id: r.employee_count for r in cl.clean_customers(_raw(spark, "customers", cust)).collect()}
    assert got == {"C1": 0, "C2": 12, "C3": 0, "C4": 42}
    inter = [dict(interaction_id="I1", channel="Phone"), dict(interaction_id="I2", channel="E-MAIL"),
             dict(interaction_id="I3", channel="WhatsApp Message"), dict(interaction_id="I4", channel="sms"),
             dict(interaction_id="I5", channel=None), dict(interaction_id="I6", channel="\tcall")]
    got = {r.interaction_id: r for r in cl.clean_interactions(_raw(spark, "interactions", inter)).collect()}
    assert [got[f"I{i}"].channel_standardized for i in range(1, 6)] == ["call", "email", "whatsapp", "sms", None]
    assert got["I6"].channel == "\tcall" and got["I6"].channel_standardized == "\tcall"
    assert got["I1"].notes == "" and got["I1"].interaction_time_minutes == 0


def test_dedupe_declared_order_any_partitioning(spark):
    rows = [dict(lead_id="L001", deal_value="2"), dict(lead_id="L001", deal_value="1"),
            dict(lead_id=None, deal_value="5"), dict(lead_id=None, deal_value="6")]
    raw = _raw(spark, "leads", rows)
    results = set()
    for n in (1, 3, 7):
        out = cl.clean_leads(raw.repartition(n)).collect()
        results.add(tuple(sorted((r.lead_id or "", r.deal_value) for r in out)))
    assert results == {(("", 5.0), ("L001", 1.0))}
    counts = dd.duplicate_counts(raw, "lead_id").first()
    assert (counts.raw_rows, counts.clean_rows, counts.duplicates_removed) == (4, 2, 2)


def test_clean_is_idempotent_and_empty_ok(spark, clean):
    empty = spark.createDataFrame([], raw_schema("leads"))
    out = cl.clean_leads(empty)
    assert out.count() == 0
    assert [f.name for f in out.schema] == clean_schema("leads").fieldNames()
    # cleaning the textual form of clean data changes nothing
    once = clean["customers"]
    as_text = once.select(*[F.col(c).cast("string").alias(c) for c in once.columns])
    as_text = as_text.withColumn("created_at", F.substring("created_at", 1, 10))
    assert sorted(cl.clean_customers(as_text).collect()) == sorted(once.collect())


def test_documented_cleaning(spark):
    df = spark.createDataFrame([("1", " Acme-Corp! ", "john.doe@acme.com", "+1 (555) 010-1234")],
                               "id string, name string, email string, phone string")
    n = cl.normalize_text(df, ["name"]).first()
    assert n.name == "acmecorp"
    m = cl.mask_contacts(df).first()
    assert m.email.endswith("@acme.com") and len(m.email) == 64 + 9
    assert m.phone == "*******1234"
    f = cl.fill_defaults(spark.createDataFrame([(None,)], "status string"), {"status": "unknown", "x": 0})
    assert f.first().status == "unknown"
    assert cl.drop_missing_keys(spark.createDataFrame([(None,), ("a",)], "customer_id string"),
                                ["customer_id"]).count() == 1


def test_parse_day_and_summary(spark):
    from dealspark.functions.cleaning import parse_day
    from dealspark.operators.profile import summary_table
    df = spark.createDataFrame([("2024-02-29",), ("2024-02-30",)], "s string")
    assert [r.d for r in df.select(parse_day("s").alias("d")).collect()] == [dt.date(2024, 2, 29), None]
    s = summary_table(spark.createDataFrame([(1.0,), (3.0,)], "x double"), "count", "mean")
    assert [(r.summary, r.x) for r in s.collect()] == [("count", "2"), ("mean", "2.0")]


def test_exact_sum_fallbacks(spark):
    from dealspark.functions.numeric import exact_sum
    df = spark.createDataFrame([("a", 0.1), ("a", 0.2), ("b", float("nan")), ("b", 1.0),
                                ("c", 1e30), ("c", 1.0), ("d", None)], "k string, v double")
    got = {r.k: r.s for r in df.groupBy("k").agg(exact_sum("v").alias("s")).collect()}
    assert got["a"] == 0.3  # exact decimal sum, not 0.30000000000000004
    assert math.isnan(got["b"]) and got["c"] == 1e30 + 1.0 and got["d"] is None


def test_typed_csv_scan(spark, sample_root):
    from dealspark.sources.layers import Layout
    from dealspark.sources.readers import read_clean_csv
    df = read_clean_csv(spark, Layout(sample_root).bronze("interactions"), "interactions")
    assert df.count() == 25
    assert dict(df.dtypes)["interaction_time_minutes"] == "int"
    assert dict(df.dtypes)["interaction_date"] == "timestamp_ntz"
