"""Run ledger, published tables, damaged files, quarantine, found pivots, sketches, scaling, shared sub-plans."""

from __future__ import annotations

import datetime as dt
import math
import os
import subprocess
import sys

import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from dealspark.operators import clean as cl
from dealspark.operators import features as ft
from dealspark.operators import ledger, ml
from dealspark.operators import profile as pf
from dealspark.operators import quality as dq
from dealspark.operators import sketches as sk
from dealspark.operators.scaling import PopulationScaler
from dealspark.plans import registry
from dealspark.schemas import RAW_COLUMNS
from dealspark.sources import readers, scratch, sinks

SF = "/root/testdata/sf0.001"


# --- DQ-5: ledger ---------------------------------------------------------------

def counts(spark, **n):
    return spark.createDataFrame(list(n.items()), "table_name string, row_count long")


def test_ledger_counts_a_run_once_and_only_whole(spark, tmp_path):
    path = str(tmp_path / "ledger")
    day = dt.datetime(2024, 1, 1)
    assert ledger.record_run(counts(spark, leads=10, customers=4), path, "a", day)
    assert ledger.growth_between_runs(ledger.read_ledger(spark, path)).count() == 0
    assert ledger.record_run(counts(spark, leads=15, products=2), path, "b", day + dt.timedelta(days=1))
    assert not ledger.record_run(counts(spark, leads=99, products=99), path, "b", day + dt.timedelta(days=1))
    # a later run whose write broke: one of its two rows is missing
    broken = ledger.read_ledger(spark, path).where("run_id = 'b' and table_name = 'leads'").withColumns(
        {"run_id": F.lit("c"), "attempt": F.lit("x"), "run_at": F.lit(dt.datetime(2025, 1, 1)).cast("timestamp_ntz")})
    broken.write.mode("append").parquet(path)
    # a second attempt of a run that was whole already
    again = ledger.read_ledger(spark, path).where("run_id = 'b'").withColumns(
        {"attempt": F.lit("y"), "row_count": F.lit(7).cast("long"), "recorded_at": F.lit(dt.datetime(2030, 1, 1)).cast("timestamp_ntz")})
    scratch.stored(again, "again").write.mode("append").parquet(path)
    got = {r.table_name: r for r in ledger.growth_between_runs(ledger.read_ledger(spark, path)).collect()}
    assert {(r.previous_run, r.current_run) for r in got.values()} == {("a", "b")}
    assert {t: (r.previous_rows, r.current_rows, r.growth_pct) for t, r in got.items()} == {
        "leads": (10, 15, 50.0), "customers": (4, None, None), "products": (None, 2, None)}
    assert ledger.record_run(counts(spark, leads=20, products=2), path, "c", dt.datetime(2025, 1, 1))  # the broken run, done again
    assert {r.current_run for r in ledger.growth_between_runs(ledger.read_ledger(spark, path)).collect()} == {"c"}


# --- SNK-1/2: published tables ---------------------------------------------------

def test_a_broken_write_leaves_the_old_table(spark, tmp_path):
    path = str(tmp_path / "table")
    sinks.publish(spark.range(5), path)
    bad = spark.range(1000).repartition(4).withColumn("id", F.when(F.col("id") == 777, F.raise_error(F.lit("broken"))).otherwise(F.col("id")).cast("long"))
    with pytest.raises(Exception, match="broken"):
        sinks.publish(bad, path)
    assert readers.read_parquet(spark, path).count() == 5
    reader = readers.read_parquet(spark, path)
    for n in (6, 7):
        sinks.publish(spark.range(n), path)
        assert readers.read_parquet(spark, path).count() == n
        if n == 6:
            assert reader.count() == 5  # one older version stays for readers at work
    assert len(os.listdir(f"{path}/_versions")) == 2 and not [f for f in os.listdir(path) if f.startswith("_next")]
    spark.range(3).write.parquet(str(tmp_path / "plain"))
    assert readers.read_parquet(spark, str(tmp_path / "plain")).count() == 3


# --- DQ-2: values and quarantine -------------------------------------------------

def test_violations_are_the_nulls_that_cleaning_introduces(spark):
    raw = spark.createDataFrame([
        ("1", "10.5", "2024-01-02", "2024-01-02"), ("2", "n/a", "2024-13-01", "2024-01-02"), ("2", "n/a", None, None),
        (None, " ", "2024-01-02", "x"), ("4", None, None, None)], "lead_id string, deal_value string, created_at string, updated_at string")
    raw = raw.select(*[F.col(c) if c in raw.columns else F.lit("t").alias(c) for c in RAW_COLUMNS["leads"]])
    casts = cl.declared_casts("leads")
    assert {c: t for c, (t, _) in casts.items()} == {"deal_value": "double", "created_at": "timestamp_ntz", "updated_at": "timestamp_ntz"}
    got = sorted(tuple(r) for r in dq.cast_violations(raw, casts, "lead_id", "leads").fillna("").collect())
    assert got == sorted([("leads", "2", "deal_value", "double", "n/a"), ("leads", "2", "created_at", "timestamp_ntz", "2024-13-01"),
                          ("leads", "2", "deal_value", "double", "n/a"), ("leads", "", "deal_value", "double", " "),
                          ("leads", "", "updated_at", "timestamp_ntz", "x")])
    introduced = raw.select(*[F.count_if(F.col(c).isNotNull() & p.isNull()).alias(c) for c, (_, p) in casts.items()]).first()
    assert sum(introduced) == len(got)


def test_split_write_reads_once_and_loses_nothing(spark, tmp_path):
    reads = spark.sparkContext.accumulator(0)

    def seen(batches):
        for b in batches:
            reads.add(b.num_rows)
            yield b

    raw = spark.createDataFrame([("1", "5"), ("2", "x"), ("3", None)], "id string, v string").mapInArrow(seen, "id string, v string")
    valid, bad = sinks.write_split(raw, dq.casts_hold({"v": ("int", F.col("v").try_cast("int"))}), str(tmp_path / "split"))
    assert sorted(r.id for r in valid.collect()) == ["1", "3"] and [r.id for r in bad.collect()] == ["2"]
    assert reads.value == 3 and valid.columns == ["id", "v"]


# --- SRC-1: damaged files --------------------------------------------------------

HEADER = ",".join(RAW_COLUMNS["products"])


@pytest.mark.parametrize("quoted_breaks", [False, True])
def test_damaged_records_are_kept(spark, tmp_path, quoted_breaks):
    folder = tmp_path / "products"
    folder.mkdir()
    lines = ["1,Lamp,Home,10.5,USD,2024-01-02", "2,Short,Home", '3,"Too, many",Home,1,USD,2024-01-02,extra,more', "4,,,,,"]
    (folder / "a.csv").write_text("\n".join([HEADER, *lines]) + "\n")
    (folder / "b.csv").write_text("\n".join([HEADER, "5,Desk,Office,7,USD,2024-02-03", '6,"never closed,Office,7,USD,2024-02-03']) + "\n")
    checked = readers.read_bronze_checked(spark, str(folder), "products", quoted_breaks)
    sound, damaged = readers.split_corrupt(checked)
    assert sorted(r.product_id for r in sound.collect()) == ["1", "4", "5"] and sound.columns == list(RAW_COLUMNS["products"])
    rows = {r[readers.CORRUPT].split(",")[0]: r for r in damaged.collect()}
    assert set(rows) == {"2", "3", "6"} and rows["3"][readers.CORRUPT] == lines[2]
    assert rows["6"][readers.FILE].endswith("b.csv") and rows["2"].product_name == "Short"
    assert checked.count() == 6 and checked.select("product_id").count() == 6  # also where few columns are read


def test_quoted_line_breaks_and_header_drift(spark, tmp_path):
    folder = tmp_path / "products"
    folder.mkdir()
    (folder / "a.csv").write_text(f'{HEADER}\n1,"two\nlines",Home,10.5,USD,2024-01-02\n2,Lamp,Home,1,USD,2024-01-02\n')
    sound, damaged = readers.split_corrupt(readers.read_bronze_checked(spark, str(folder), "products", quoted_breaks=True))
    assert {r.product_id: r.product_name for r in sound.collect()} == {"1": "two\nlines", "2": "Lamp"} and damaged.count() == 0
    drift = tmp_path / "drift"
    drift.mkdir()
    (drift / "a.csv").write_text(HEADER.replace("currency", "money") + "\n1,Lamp,Home,10.5,USD,2024-01-02\n")
    with pytest.raises(Exception, match="(?i)header"):
        readers.read_bronze_checked(spark, str(drift), "products").collect()


# --- AG-17 / AG-18 / MT-16: pivots over the values that occur --------------------

def test_an_unseen_channel_gets_its_column(spark, clean):
    more = clean["interactions"].unionByName(clean["interactions"].limit(3).withColumns(
        {"channel": F.lit("Carrier Pigeon"), "interaction_id": F.concat(F.lit("p"), "interaction_id")}))
    got = ft.pivot_counts(more, "channel")
    assert "num_carrier_pigeon" in got.columns and got.agg(F.sum("num_carrier_pigeon")).first()[0] == 3
    wide = ft.eda_customer_features(clean["customers"], more, clean["leads"], channels=None, outcomes=None)
    assert wide.agg(F.sum("num_carrier_pigeon")).first()[0] == 3
    total = sum(got.agg(*[F.sum(c) for c in got.columns if c != "customer_id"]).first())
    assert total == more.where("customer_id is not null and channel is not null").count()
    with pytest.raises(ValueError, match="over 2 values"):
        ft.occurring_values(more, "channel", 2)
    clash = spark.createDataFrame([("1", "a b"), ("1", "a-b")], "customer_id string, channel string")
    with pytest.raises(ValueError, match="one column name"):
        ft.pivot_counts(clash, "channel")


# --- AG-5 / AG-12: sketches ------------------------------------------------------

def test_distinct_sketches_roll_up_within_the_error(spark):
    rows = spark.range(120_000).select((F.col("id") % 40_000).alias("customer"), (F.col("id") % 30).alias("day"),
                                       F.when(F.col("id") % 3 == 0, "a").otherwise("b").alias("channel"))
    daily = scratch.stored(sk.distinct_sketches(rows, ["day", "channel"], "customer"), "daily")
    for keys in (["channel"], ["day"], []):
        exact = rows.groupBy(*keys).agg(F.count_distinct("customer").alias("exact"), F.count(F.lit(1)).alias("n"))
        for r in (exact.join(sk.rolled_up_distinct(daily, keys, "estimate"), keys) if keys
                  else exact.crossJoin(sk.rolled_up_distinct(daily, keys, "estimate"))).collect():
            assert abs(r.estimate - r.exact) <= sk.DISTINCT_ERROR * r.exact and r.rows == r.n


def test_quantile_sketches_keep_their_rank_error(spark):
    rows = spark.range(200_000).select(
        F.pmod(F.xxhash64("id"), F.lit(64)).alias("part"), F.lit(7.0).alias("constant"), F.exp(F.pmod(F.xxhash64("id", F.lit(1)), F.lit(5000)) / 250.0).alias("skewed"),
        F.when(F.col("id") % 10 < 8, 0.0).when(F.col("id") % 1000 == 9, F.lit(float("nan"))).otherwise(F.col("id").cast("double")).alias("heaped"),
        F.lit(None).cast("double").alias("empty"))
    columns, quantiles = ["constant", "skewed", "heaped", "empty"], [0.0, 0.01, 0.25, 0.5, 0.85, 0.99, 1.0]
    some = scratch.stored(sk.quantile_sketches(rows, ["part"], columns), "quantiles")
    found = sk.rolled_up_quantiles(some, [], columns, quantiles)
    values = {(r.column_name, r.quantile): r.value for r in found.collect()}
    assert all(values["constant", q] == 7.0 and values["empty", q] is None for q in quantiles)
    for r in sk.rank_errors(rows, found.where("value is not null"), columns).collect():
        assert r.rank_error <= sk.RANK_ERROR, r


# --- ML-7, ML-12 -----------------------------------------------------------------

def test_scaler_uses_the_population_and_reloads(spark, tmp_path):
    values = [(1.0, 5.0, 1e9), (2.0, 5.0, 1e9 + 1), (4.0, 5.0, 1e9 + 2), (9.0, 5.0, 1e9 + 9)]
    df = spark.createDataFrame(values, "a double, b double, c double")
    stages = [VectorAssembler(inputCols=["a", "b", "c"], outputCol="features"), PopulationScaler(inputCol="features", outputCol="scaled")]
    Pipeline(stages=stages).fit(df).write().overwrite().save(str(tmp_path / "model"))
    model = PipelineModel.load(str(tmp_path / "model"))
    mean = [sum(c) / 4 for c in zip(*values)]
    std = [math.sqrt(sum((x - m) ** 2 for x in c) / 4) for c, m in zip(zip(*values), mean)]
    assert model.stages[1].getOrDefault("mean") == pytest.approx(mean, rel=1e-12)
    assert model.stages[1].getOrDefault("std") == pytest.approx(std, rel=1e-12, abs=1e-12)
    for r in model.transform(df).collect():
        want = [(x - m) / s if s else 0.0 for x, m, s in zip((r.a, r.b, r.c), mean, std)]
        assert list(r.scaled) == pytest.approx(want, rel=1e-9, abs=1e-12)
    with pytest.raises(ValueError, match="empty"):
        stages[1].fit(stages[0].transform(df.limit(0)))


def test_auc_of_a_skewed_score(spark):
    """One outlier far above all other scores, and ties."""
    rows = [(k % 3 == 0, float(k % 50) / 1e6) for k in range(600)] + [(True, 1e12), (False, -1e12), (True, None)]
    pred = spark.createDataFrame([(int(y), s) for y, s in rows], "is_hot_lead int, p_hot double")
    pos, neg = ([s for y, s in rows if y == side and s is not None] for side in (True, False))
    want = sum((a > b) + (a == b) / 2 for a in pos for b in neg) / len(pos) / len(neg)
    assert ml.roc_auc(pred).first()["roc_auc"] == pytest.approx(want, rel=1e-12)


def test_both_classifiers_recover_a_fixed_rule(spark):
    """A floor on accuracy on a fixed table (ML-8, ML-9)."""
    rows = spark.range(600).select(F.col("id").cast("string").alias("customer_id"), (F.col("id") % 37).cast("double").alias("a"),
                                   (F.col("id") * 7 % 53).cast("double").alias("b"))
    rows = rows.withColumn(ml.LABEL, ((F.col("a") > 18) & (F.col("b") < 30) | (F.col("b") > 45)).cast("int"))
    train, test = rows.where("customer_id % 4 > 0"), rows.where("customer_id % 4 = 0")
    for name in ("rf", "gbt"):
        metrics = ml.binary_metrics(ml.score(ml.train(train, ["a", "b"], name), test, "customer_id")).first()
        assert metrics.accuracy >= 0.95 and metrics.f1 >= 0.93, name


# --- shared sub-plans and scratch tables -----------------------------------------

@pytest.mark.parametrize("name", ["lead_score_histogram", "feature_summary", "quality_distribution", "ml_labels", "train_test_split", "analysis_report"])
def test_features_are_derived_once(spark, monkeypatch, name):
    made = []
    for f in ("customer_features", "eda_customer_features"):
        real = getattr(ft, f)
        monkeypatch.setattr(ft, f, lambda *a, _real=real, **b: made.append(1) or _real(*a, **b))
    plan = registry.REGISTRY[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert len(made) == 1
    assert "testdata" not in plan  # all that is left reads intermediate tables


def test_histogram_of_one_value_and_of_none(spark):
    one = pf.score_histogram(spark.createDataFrame([(3.0,), (3.0,), (None,)], "lead_score double"), bins=3).collect()
    assert [(r.bin, r.bin_start, r.bin_end, r.customers) for r in one] == [(0, 3.0, 3.0, 2), (1, 3.0, 3.0, 0), (2, 3.0, 3.0, 0)]
    assert pf.score_histogram(spark.createDataFrame([], "lead_score double")).count() == 0


def test_release_deletes_what_was_made(spark):
    since = scratch.mark(spark)
    gone, kept = scratch.stored(spark.range(3), "gone"), scratch.stored(spark.range(3), "kept")
    paths = [df.inputFiles()[0].rsplit("/", 1)[0].removeprefix("file://") for df in (gone, kept)]
    assert scratch.release(spark, since, scratch.mark(spark) - 1) == 1
    assert kept.count() == 3 and [os.path.exists(p) for p in paths] == [False, True]
    assert scratch.release(spark, since) == 1 and not os.path.exists(paths[1])


SCRIPT = """
import sys; sys.path.insert(0, {root!r})
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[1]").config("spark.ui.enabled", "false").getOrCreate()
spark.sparkContext.setLogLevel("OFF")
assert spark.conf.get("spark.checkpoint.dir", None) is None, "set already"
from dealspark.session import ensure_checkpoint_dir
from dealspark.sources.scratch import stored, shared_root
assert stored(spark.range(4), "x").count() == 4 and ensure_checkpoint_dir(spark)
spark.sparkContext.master = "spark://host:1"
spark.sparkContext.__class__.getCheckpointDir = lambda self: None
try:
    shared_root(spark)
except ValueError as e:
    assert "spark.checkpoint.dir" in str(e)
    print("clear error")
"""


def test_session_without_a_checkpoint_setting(tmp_path):
    """In a session of its own, with an empty Spark configuration: a local one works, a cluster one names the setting."""
    (tmp_path / "spark-defaults.conf").write_text("")
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    out = subprocess.run([sys.executable, "-c", SCRIPT.format(root=root)], capture_output=True, text=True, timeout=180,
                         env={**os.environ, "SPARK_CONF_DIR": str(tmp_path)})
    assert "clear error" in out.stdout, out.stderr[-2000:]
