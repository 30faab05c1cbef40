"""Data-quality checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from dealspark.operators import profile as pf
from dealspark.operators import quality as dq
from dealspark.schemas import clean_schema


def test_orphans_and_null_keys(spark, clean):
    extra = spark.createDataFrame([("X1", "C999"), ("X2", None)], "lead_id string, customer_id string")
    leads = clean["leads"].select("lead_id", "customer_id").unionByName(extra)
    o = dq.orphans(leads, clean["customers"], "lead_id")
    assert sorted(r.lead_id for r in o.collect()) == ["X1", "X2"]
    counts = {r.table_name: r.orphan_rows for r in dq.orphan_counts(
        {"leads": leads, "interactions": clean["interactions"]}, clean["customers"]).collect()}
    assert counts == {"leads": 2, "interactions": 0}


def test_ranges_types_completeness(spark, clean):
    rules = {"rev": F.col("annual_revenue") >= 0, "emp": F.col("employee_count") > 1000}
    v = {r.rule: r.violations for r in dq.range_violations(clean["customers"], "customers", rules).collect()}
    assert v == {"rev": 0, "emp": 10}
    assert dq.type_mismatches(clean["customers"], clean_schema("customers"), "customers").count() == 0
    bad = clean["customers"].withColumn("employee_count", F.col("employee_count").cast("string"))
    mm = dq.type_mismatches(bad, clean_schema("customers"), "customers").first()
    assert (mm.column_name, mm.expected_type, mm.actual_type) == ("employee_count", "int", "string")
    c = dq.completeness(clean["leads"], "leads").first()
    assert (c.rows, c.cells, c.non_null_cells) == (15, 180, 177)


def test_metrics_and_growth(raw, clean):
    m = {r.metric: r.value for r in dq.clean_layer_metrics(
        raw["leads"], clean["leads"], "leads", ("email", "phone"), ("is_contactable",),
        ("deal_value",)).collect()}
    assert m == {"raw_rows": 15, "duplicates_removed": 0, "clean_rows": 15, "null_email": 1, "null_phone": 2,
                 "is_contactable_count": 15, "deal_value_min": 15000.0, "deal_value_max": 550000.0}
    prev = pf.row_counts({"leads": raw["leads"], "customers": raw["customers"]})
    cur = pf.row_counts({"leads": clean["leads"].limit(12), "products": clean["products"]})
    g = {r.table_name: r for r in dq.volume_growth(prev, cur).collect()}
    assert (g["leads"].row_change, g["leads"].growth_pct) == (-3, -20.0)
    assert g["customers"].current_rows is None and g["products"].previous_rows is None
