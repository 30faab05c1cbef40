"""End-to-end layered run on the sample."""

from __future__ import annotations

import datetime as dt
import os

from dealspark.plans import layered
from dealspark.sources.layers import Layout
from dealspark.sources.readers import read_parquet

import crm_data


def test_layered_round_trip(spark, tmp_path):
    root = crm_data.write_bronze(str(tmp_path))
    layout = Layout(root)
    run_ts = dt.datetime(2024, 12, 1, 2, 0)
    silver = layered.bronze_to_silver(spark, layout, run_ts=run_ts)
    leads = read_parquet(spark, silver["leads"])
    assert leads.count() == 15 and "processed_at" in leads.columns
    assert {r.processed_at for r in leads.select("processed_at").distinct().collect()} == {run_ts}
    q = read_parquet(spark, silver["_quality"])
    assert q.where("table_name = 'interactions' AND metric = 'clean_rows'").first().value == 25
    gold = layered.silver_to_gold(spark, layout, dt.date(2024, 12, 1), run_ts=run_ts)
    counts = {t: read_parquet(spark, p).count() for t, p in gold.items()}
    assert counts == {"customer_features": 13, "sales_summary": 15, "channel_performance": 3,
                      "top_customers": 13}
    out = layered.analysis(spark, layout, str(tmp_path / "analysis"))
    csv = spark.read.option("header", True).csv(out["features_csv"])
    assert csv.count() == 13 and "lead_quality" in csv.columns
    assert read_parquet(spark, out["report"]).where("metric = 'total_leads'").first().value == 15


def test_model_run(spark, tmp_path):
    rows = [(f"C{i:03d}", float(i % 11), float(i % 7), float(i * 10.0), float(i % 11) * 10) for i in range(120)]
    f = spark.createDataFrame(rows, "customer_id string, total_interactions double, num_calls double, "
                                    "total_revenue double, lead_score double")
    best, metrics = layered.train_lead_model(spark, f, str(tmp_path / "m"))
    got = {r.model: r for r in metrics.collect()}
    assert set(got) == {"rf", "gbt", "reloaded"} and best in ("rf", "gbt")
    assert got["reloaded"].accuracy == got[best].accuracy


def test_bucketed_clean_layer_needs_no_shuffle(spark, tmp_path):
    from dealspark.operators import features as ft
    root = crm_data.write_bronze(str(tmp_path))
    layout = Layout(root)
    layered.bronze_to_silver(spark, layout, buckets=4, table_prefix="bkt_")
    c, l, i = (layered.read_silver(spark, layout, e, True, "bkt_")
               for e in ("customers", "leads", "interactions"))
    f = ft.customer_features(c, i, l, dt.date(2024, 12, 1))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = f._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "Exchange" not in plan
    plain = [layered.read_silver(spark, layout, e) for e in ("customers", "leads", "interactions")]
    g = ft.customer_features(plain[0], plain[2], plain[1], dt.date(2024, 12, 1))
    assert sorted(f.collect()) == sorted(g.collect())
    gold = layered.silver_to_gold(spark, layout, dt.date(2024, 12, 1), bucketed=True, table_prefix="bkt_")
    assert read_parquet(spark, gold["customer_features"]).count() == 13


def test_command_line(spark, tmp_path):
    from dealspark.__main__ import main
    root = crm_data.write_bronze(str(tmp_path))
    out = main(["raw-to-clean", "--root", root], spark)
    assert set(out) >= {"leads", "customers", "interactions", "products", "_quality"}
    out = main(["clean-to-curated", "--root", root, "--as-of", "2024-12-01"], spark)
    feats = read_parquet(spark, out["customer_features"])
    assert feats.where("lead_quality = 'hot'").count() == 2
    out = main(["analysis", "--root", root, "--out", str(tmp_path / "analysis")], spark)
    assert "report" in out


def test_train_from_features_csv(spark, tmp_path):
    from dealspark.__main__ import main
    root = crm_data.write_bronze(str(tmp_path))
    main(["raw-to-clean", "--root", root], spark)
    main(["analysis", "--root", root, "--out", str(tmp_path / "analysis")], spark)
    out = main(["train", "--root", root, "--features-csv", str(tmp_path / "analysis" / "customer_features_csv"),
                "--model-output", str(tmp_path / "model")], spark)
    assert out["model"] in ("rf", "gbt")
    assert {m["model"] for m in out["metrics"]} == {"rf", "gbt", "reloaded"}
