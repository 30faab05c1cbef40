"""Exact sums, selection by rank, exact AUC and salted joins."""

from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from dealspark.operators import ml
from dealspark.operators import profile as pf
from dealspark.operators import quality as dq
from dealspark.operators.select import narrowed
from dealspark.operators.skew import salted_join


def test_small_values_are_not_cut(spark):
    df = spark.range(10_000).select(F.lit("k").alias("k"), F.lit(0.00004).alias("v"), F.lit("open").alias("status"),
                                    F.lit(0.00004).alias("deal_value"))
    assert pf.column_stats(df, "t", ["v"]).first().sum_value == pytest.approx(0.4)
    assert pf.sum_by(df, "k", "v", "s").first().s == pytest.approx(0.4)
    assert pf.status_breakdown(df).first().deal_value == pytest.approx(0.4)


def test_nan_and_huge_values_are_not_dropped(spark):
    df = spark.createDataFrame([(1.0,), (3.0,), (1e30,)], "v double")
    assert pf.column_stats(df, "t", ["v"]).first().sum_value == pytest.approx(1e30)
    with_nan = df.unionByName(spark.createDataFrame([(float("nan"),)], "v double"))
    assert math.isnan(pf.column_stats(with_nan, "t", ["v"]).first().mean_value)
    got = {r.stat: r.value for r in pf.describe_columns(with_nan, "t", {"v": ("sum", "mean")}).collect()}
    assert math.isnan(got["sum"]) and math.isnan(got["mean"])


@pytest.mark.parametrize("values", [
    np.random.default_rng(1).normal(1e6, 1, 40_001), np.random.default_rng(2).lognormal(0, 20, 40_000),
    np.r_[np.full(30_000, 7.0), np.linspace(-1e300, 1e300, 20_001)], np.array([1.0, 100.0]), np.array([5.0])])
def test_median_is_exact(spark, values):
    df = spark.createDataFrame([(float(v),) for v in values], "v double").repartition(4)
    assert pf.exact_medians(df, ["v"]).first().median == np.median(values)


def test_band_is_thin(spark):
    """Rows that reach the ranking do not grow with the table."""
    sizes = []
    for n in (20_000, 200_000):
        df = spark.range(n).select(F.lit("c").alias("g"), (F.rand(3) * 1000).alias("p"))
        low = F.floor(F.col("n") / 2)
        wide = narrowed(df, "g", "p", F.lit(0.0), F.lit(1000.0), None, low, low)
        thin = narrowed(df, "g", "p", F.lit(0.0), F.lit(1000.0), wide, low, low).first()
        sizes.append(df.where((F.col("p") >= thin.lo) & (F.col("p") <= thin.hi)).count())
    assert max(sizes) <= 2


def test_split_takes_the_smallest_hashes(spark):
    df = spark.range(30_000).select(F.col("id").cast("string").alias("id"), (F.col("id") % 3 == 0).cast("int").alias("y"))
    got = {(r.y, r.split): r.n for r in ml.stratified_split(df, "id", "y").groupBy("y", "split").agg(
        F.count("*").alias("n")).collect()}
    assert got == {(0, "test"): 4000, (0, "train"): 16000, (1, "test"): 2000, (1, "train"): 8000}
    few = ml.stratified_split(df.limit(2), "id", "y")
    assert few.where("split = 'test'").count() == 0


def test_auc_is_exact(spark):
    rng = np.random.default_rng(5)
    y, s = rng.integers(0, 2, 3000), rng.integers(0, 900, 3000) / 7
    pred = spark.createDataFrame([(int(a), float(b)) for a, b in zip(y, s)], "y int, s double")
    pos, neg = s[y == 1], s[y == 0]
    want = ((pos[:, None] > neg).sum() + 0.5 * (pos[:, None] == neg).sum()) / (len(pos) * len(neg))
    assert ml.roc_auc(pred, "y", "s").first().roc_auc == pytest.approx(want, abs=1e-12)
    assert ml.roc_auc(pred.where("y = 1"), "y", "s").first().roc_auc is None


def test_hot_key_is_spread(spark):
    rows = spark.range(30_000).select("id", F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).alias("k"))
    right = rows.groupBy("k").agg(F.count("*").alias("n"))
    old = {c: spark.conf.get(c) for c in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled",
                                          "spark.sql.shuffle.partitions")}
    try:
        for c, v in zip(old, ("-1", "false", "8")):
            spark.conf.set(c, v)
        joined = salted_join(rows, right, "k", "left", "id")
        assert joined.count() == 30_000 and joined.where("k = 0 and n <> 10000").count() == 0
        sizes = [r.n for r in joined.groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n")).collect()]
        assert max(sizes) <= 2 * sum(sizes) / 8
    finally:
        for c, v in old.items():
            spark.conf.set(c, v)


def test_orphan_rows(spark):
    child = spark.createDataFrame([(1, "a"), (2, "b"), (3, None), (4, "b")], "id int, customer_id string")
    parent = spark.createDataFrame([("a",), ("a",)], "customer_id string")
    assert sorted(r.id for r in dq.orphans(child, parent, "id").collect()) == [2, 3, 4]
