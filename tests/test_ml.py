"""Model mechanics: labels, split exactness, metric formulas, save/load."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from dealspark.operators import features as ft
from dealspark.operators import ml


@pytest.fixture(scope="module")
def labelled(clean):
    f = ft.customer_features(clean["customers"], clean["interactions"], clean["leads"], dt.date(2024, 12, 1))
    return ml.make_label(f).cache()


def test_labels(labelled, spark):
    assert labelled.where(F.col(ml.LABEL) == 1).count() == 2
    med = ml.median_label(labelled.drop("lead_score", ml.LABEL))
    # revenue median 0, interaction median 2: customers with revenue > 0 and n > 2
    assert sorted(r.customer_id for r in med.where(F.col(ml.LABEL) == 1).collect()) == ["C001", "C002"]
    assert ml.available_features(labelled) == list(ml.FEATURES)
    assert ml.available_features(labelled.drop("win_rate", "annual_revenue")) == [
        c for c in ml.FEATURES if c not in ("win_rate", "annual_revenue")]


def test_split_exact_and_stable(spark):
    df = spark.range(1000).select(F.col("id").cast("string").alias("id"),
                                  (F.col("id") % 3 == 0).cast("int").alias(ml.LABEL))
    s1 = ml.stratified_split(df, "id")
    counts = {(r[ml.LABEL], r.split): r["count"] for r in s1.groupBy(ml.LABEL, "split").count().collect()}
    assert counts[(1, "test")] == round(334 * 0.2) and counts[(0, "test")] == round(666 * 0.2)
    a = sorted(r.id for r in s1.where("split = 'test'").collect())
    b = sorted(r.id for r in ml.stratified_split(df.repartition(7), "id").where("split = 'test'").collect())
    assert a == b
    c = sorted(r.id for r in ml.stratified_split(df, "id", seed=7).where("split = 'test'").collect())
    assert a != c


def test_metrics_on_fixed_predictions(spark):
    pred = spark.createDataFrame([(1, 1), (1, 0), (0, 0), (0, 0), (0, 1), (1, 1)],
                                 f"{ml.LABEL} int, prediction int")
    m = ml.binary_metrics(pred).first()
    assert (m.tp, m.fp, m.fn, m.tn) == (2, 1, 1, 2)
    assert (m.accuracy, m.precision, m.recall) == (4 / 6, 2 / 3, 2 / 3)
    assert abs(m.f1 - 2 / 3) < 1e-12
    rep = {r.class_label: r for r in ml.classification_report(pred).collect()}
    assert rep["1"].support == 3 and rep["0"].support == 3 and rep["accuracy"].f1 == 4 / 6
    one = spark.createDataFrame([(1, 1), (1, 1)], f"{ml.LABEL} int, prediction int")
    m1 = ml.binary_metrics(one).first()
    assert (m1.tn, m1.fp, m1.fn, m1.tp, m1.precision) == (0, 0, 0, 2, 1.0)
    assert ml.select_model({"rf": 0.9, "gbt": 0.9}) == "gbt"
    assert ml.select_model({"rf": 0.95, "gbt": 0.9}) == "rf"


def test_train_save_load(spark, tmp_path):
    rows = [(str(i), float(i % 17), float(i % 5), int(i % 17 > 8)) for i in range(200)]
    df = spark.createDataFrame(rows, f"id string, a double, b double, {ml.LABEL} int")
    model = ml.train(df, ["a", "b"], "rf")
    pred = ml.score(model, df, "id")
    path = str(tmp_path / "model")
    ml.save_model(model, path)
    again = ml.score(ml.load_model(path), df, "id")
    assert sorted(pred.collect()) == sorted(again.collect())
    assert ml.model_features(ml.load_model(path)) == ["a", "b"]
    assert ml.binary_metrics(pred).first().accuracy > 0.95
    assert 0.95 < ml.roc_auc(pred).first()["roc_auc"] <= 1.0


def test_random_split(spark):
    df = spark.range(2000).select(F.col("id").cast("string").alias("id"))
    s = ml.random_split(df, 0.2, 42)
    assert s.count() == 2000
    n_test = s.where("split = 'test'").count()
    assert 300 < n_test < 500
