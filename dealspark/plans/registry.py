"""Named queries over the benchmark tables (one per operator of the survey).

Each entry is ``(spark, sf_dir) -> DataFrame``. Every query reads the whole
benchmark tables through the adapters, cleans them and runs the operator;
nothing is sampled or capped except where a limit is the feature (top-k).
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dealspark.operators import aggregate as agg
from dealspark.operators import clean as cl
from dealspark.operators import features as ft
from dealspark.operators import topk
from dealspark.plans.profiles import EDA, NOTEBOOK
from dealspark.sources import driver_tables as dt
from dealspark.sources.scratch import scratch_path, stored

Query = Callable[[SparkSession, str], DataFrame]

# Benchmark profiles: the reference rules with the benchmark revenue unit.
BENCH_NOTEBOOK = NOTEBOOK.with_(revenue_unit=dt.REVENUE_UNIT)
BENCH_EDA = EDA.with_(revenue_unit=dt.REVENUE_UNIT)


class Tables:
    """Raw and clean views of the benchmark tables for one query."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def raw(self, entity: str) -> DataFrame:
        return dt.RAW[entity](self.spark, self.sf_dir)

    def clean(self, entity: str) -> DataFrame:
        return cl.CLEANERS[entity](self.raw(entity))

    def narrow(self, entity: str, columns) -> DataFrame:
        """Some columns of a clean table, derived and written once, for queries that read them in several passes."""
        return stored(self.clean(entity).select(*columns), f"clean-{entity}")

    def stored_features(self) -> DataFrame:
        return stored(self.features(), "features")

    def stored_eda_features(self) -> DataFrame:
        return stored(self.eda_features(), "eda-features")

    def features(self) -> DataFrame:
        return ft.customer_features(self.clean("customers"), self.clean("interactions"),
                                    self.clean("leads"), dt.AS_OF, BENCH_NOTEBOOK)

    def eda_features(self) -> DataFrame:
        return ft.eda_customer_features(self.clean("customers"), self.clean("interactions"),
                                        self.clean("leads"), channels=dt.RAW_CHANNELS,
                                        profile=BENCH_EDA)


REGISTRY: dict[str, Query] = {}


def query(name: str):
    def deco(fn: Callable[[Tables], DataFrame]):
        REGISTRY[name] = lambda spark, sf_dir: fn(Tables(spark, sf_dir))
        REGISTRY[name].__doc__ = fn.__doc__
        return fn
    return deco


# --- clean layer -----------------------------------------------------------

@query("leads_clean")
def _leads_clean(t: Tables) -> DataFrame:
    """CL-12 (CL-1,3,5..8, DD-1)."""
    return t.clean("leads")


@query("customers_clean")
def _customers_clean(t: Tables) -> DataFrame:
    """CL-13 (CL-2,4)."""
    return t.clean("customers")


@query("interactions_clean")
def _interactions_clean(t: Tables) -> DataFrame:
    """CL-14 (CL-9)."""
    return t.clean("interactions")


@query("products_clean")
def _products_clean(t: Tables) -> DataFrame:
    """CL-15."""
    return t.clean("products")


# --- curated layer -----------------------------------------------------------

@query("interaction_metrics")
def _interaction_metrics(t: Tables) -> DataFrame:
    """AG-1, MT-1..4."""
    return agg.interaction_metrics(t.clean("interactions"), dt.AS_OF, BENCH_NOTEBOOK)


@query("deal_metrics")
def _deal_metrics(t: Tables) -> DataFrame:
    """AG-2, MT-5..7."""
    return agg.deal_metrics(t.clean("leads"), BENCH_NOTEBOOK)


@query("customer_features")
def _customer_features(t: Tables) -> DataFrame:
    """MT-15 (flagship): JN-1..3, MT-10..12."""
    return t.features()


@query("sales_summary")
def _sales_summary(t: Tables) -> DataFrame:
    """AG-3, MT-8, TK-1."""
    return agg.sales_summary(t.clean("leads"), BENCH_NOTEBOOK)


@query("channel_performance")
def _channel_performance(t: Tables) -> DataFrame:
    """AG-4, MT-9, TK-1."""
    return agg.channel_performance(t.clean("interactions"), BENCH_NOTEBOOK)


@query("top_customers")
def _top_customers(t: Tables) -> DataFrame:
    """TK-2: 50 customers by total revenue (ties by customer_id)."""
    return topk.top_customers(t.features())


# --- profiling and analysis (the analysis script's tables) ------------------

from dealspark.operators import profile as pf  # noqa: E402

VALUE_DISTRIBUTIONS = (
    ("leads", "status"), ("leads", "source"), ("customers", "industry"),
    ("interactions", "channel"), ("interactions", "channel_standardized"),
    ("interactions", "outcome"), ("products", "category"),
)
DESCRIBE_SPEC = {
    "leads": {"deal_value": ("sum", "mean", "median", "min", "max")},
    "customers": {"employee_count": ("mean", "median", "min", "max"),
                  "annual_revenue": ("sum", "mean", "median")},
    "interactions": {"interaction_time_minutes": ("mean", "median", "max")},
}


def _union(frames):
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


@query("eda_customer_features")
def _eda_customer_features(t: Tables) -> DataFrame:
    """MT-16 (AG-16..19, JN-4, MT-13, MT-14)."""
    return t.eda_features()


@query("value_distribution")
def _value_distribution(t: Tables) -> DataFrame:
    """AG-9, AG-10, FL-2, TK-6: value counts and shares of all rows."""
    by_table: dict[str, list[str]] = {}
    for tb, c in VALUE_DISTRIBUTIONS:
        by_table.setdefault(tb, []).append(c)
    return pf.most_frequent_first(_union([
        pf.value_distributions(t.clean(tb), cols, tb) for tb, cols in by_table.items()]))


@query("null_profile")
def _null_profile(t: Tables) -> DataFrame:
    """AG-11 over the raw tables."""
    return _union([pf.null_profile(t.raw(tb), tb)
                   for tb in ("leads", "customers", "interactions", "products")])


@query("descriptive_stats")
def _descriptive_stats(t: Tables) -> DataFrame:
    """AG-12: sum / mean / exact median / min / max."""
    return _union([pf.describe_columns(t.narrow(tb, spec), tb, spec) for tb, spec in DESCRIBE_SPEC.items()])


@query("status_breakdown")
def _status_breakdown(t: Tables) -> DataFrame:
    """AG-13, AG-14, TK-6 (statuses by deal value)."""
    return pf.by_value_first(pf.status_breakdown(t.clean("leads")))


@query("industry_revenue")
def _industry_revenue(t: Tables) -> DataFrame:
    """AG-15."""
    return pf.sum_by(t.clean("customers"), "industry", "annual_revenue", "annual_revenue")


@query("quality_distribution")
def _quality_distribution(t: Tables) -> DataFrame:
    """AG-20 on the analysis-rule features."""
    return pf.quality_distribution(t.stored_eda_features())


@query("notebook_quality_distribution")
def _notebook_quality_distribution(t: Tables) -> DataFrame:
    """AG-20 / AG-10 on the notebook-rule features."""
    return pf.quality_distribution(t.stored_features())


@query("feature_summary")
def _feature_summary(t: Tables) -> DataFrame:
    """AG-21. The means of unrounded doubles are rounded here, as a double sum
    depends on how partitions are merged."""
    one = pf.feature_summary(t.stored_eda_features())
    return one.withColumns({c: F.round(c, 6) for c in ("mean_lead_score", "mean_engagement_score")})


@query("lead_score_histogram")
def _lead_score_histogram(t: Tables) -> DataFrame:
    """AG-22: 15 equal-width bins."""
    return pf.score_histogram(t.stored_eda_features(), "lead_score", 15)


@query("revenue_interaction_points")
def _revenue_interaction_points(t: Tables) -> DataFrame:
    """AG-23: interactions vs revenue, coloured by score."""
    return pf.scatter_points(t.eda_features(), "customer_id", "total_interactions",
                             "total_revenue", "lead_score")


@query("size_revenue_points")
def _size_revenue_points(t: Tables) -> DataFrame:
    """AG-23: employees vs annual revenue."""
    return pf.scatter_points(t.clean("customers"), "customer_id", "employee_count", "annual_revenue")


@query("top10_revenue")
def _top10_revenue(t: Tables) -> DataFrame:
    """TK-3."""
    return topk.top_by_revenue_ascending(t.eda_features(), 10)


@query("top10_lead_score")
def _top10_lead_score(t: Tables) -> DataFrame:
    """TK-4."""
    return topk.top_by_lead_score(t.eda_features(), 10)


@query("top5_industries")
def _top5_industries(t: Tables) -> DataFrame:
    """TK-5."""
    return pf.top_values(t.clean("customers"), "industry", 5, "customers")


# --- data quality ----------------------------------------------------------------

from dealspark.functions.scoring import recency_engagement  # noqa: E402
from dealspark.plans import layered  # noqa: E402
from dealspark.operators import dedupe as dd  # noqa: E402
from dealspark.operators import ledger  # noqa: E402
from dealspark.operators import quality as dq  # noqa: E402
from dealspark.operators import sketches as sk  # noqa: E402
from dealspark.sources.sinks import write_parquet, write_split  # noqa: E402
from dealspark.functions.cleaning import parse_day  # noqa: E402
from dealspark.schemas import KEYS, clean_schema  # noqa: E402

QUALITY_SPEC = layered.QUALITY_SPEC
# The documented ranges every clean table must satisfy.
def range_rules():
    return {
        "leads": {"deal_value_non_negative": F.col("deal_value") >= 0,
                  "status_known": F.col("status").isin("open", "closed_won", "closed_lost")},
        "customers": {"annual_revenue_non_negative": F.col("annual_revenue") >= 0,
                      "employee_count_non_negative": F.col("employee_count") >= 0},
        "interactions": {"duration_non_negative": F.col("interaction_time_minutes") >= 0,
                         "date_present": F.col("interaction_date").isNotNull()},
    "products": {"base_price_non_negative": F.col("base_price") >= 0},
    }


@query("clean_layer_metrics")
def _clean_layer_metrics(t: Tables) -> DataFrame:
    """DQ-1, FL-1, FL-2, AG-7, AG-8, DD-2."""
    return _union([dq.clean_layer_metrics(t.raw(tb), t.clean(tb), tb, **spec) for tb, spec in QUALITY_SPEC.items()]
                  + [dq.distribution_metrics(pf.value_distributions(t.clean(tb), columns, tb))
                     for tb, columns in layered.QUALITY_DISTRIBUTIONS.items()])


@query("duplicate_counts")
def _duplicate_counts(t: Tables) -> DataFrame:
    """DD-2 per table."""
    return _union([dd.duplicate_counts(t.raw(tb), KEYS[tb]).select(F.lit(tb).alias("table_name"), "*")
                   for tb in QUALITY_SPEC])


@query("column_stats")
def _column_stats(t: Tables) -> DataFrame:
    """AG-7: whole-table min / max / mean / sum."""
    return _union([
        pf.column_stats(t.clean("leads"), "leads", ["deal_value"]),
        pf.column_stats(t.clean("customers"), "customers", ["employee_count", "annual_revenue"]),
        pf.column_stats(t.clean("products"), "products", ["base_price"]),
        pf.column_stats(t.clean("interactions"), "interactions", ["interaction_time_minutes"]),
        pf.column_stats(agg.interaction_metrics(t.clean("interactions"), dt.AS_OF, BENCH_NOTEBOOK),
                        "interaction_metrics", ["total_interactions", "engagement_score"]),
        pf.column_stats(agg.deal_metrics(t.clean("leads"), BENCH_NOTEBOOK), "deal_metrics",
                        ["total_revenue", "conversion_rate", "avg_deal_value"]),
    ])


@query("deal_date_range")
def _deal_date_range(t: Tables) -> DataFrame:
    """AG-7: first and last deal date."""
    return pf.date_range(t.clean("leads"), "leads", ["created_at", "updated_at"])


def _layer_counts(t: Tables) -> DataFrame:
    """Rows of the raw and clean tables: the key column alone, counted once."""
    return _union([dd.duplicate_counts(t.raw(tb), KEYS[tb]).select(F.lit(tb).alias("table_name"), "*")
                   for tb in QUALITY_SPEC])


@query("row_counts")
def _row_counts(t: Tables) -> DataFrame:
    """AG-8: rows per raw and clean table."""
    layers = F.explode(F.array(F.struct(F.lit("raw_").alias("layer"), F.col("raw_rows").alias("row_count")),
                               F.struct(F.lit("clean_").alias("layer"), F.col("clean_rows").alias("row_count"))))
    return _layer_counts(t).select("table_name", layers.alias("s")).select(
        F.concat("s.layer", "table_name").alias("table_name"), "s.row_count")


@query("range_violations")
def _range_violations(t: Tables) -> DataFrame:
    """DQ-2: documented range rules, violations per rule."""
    return _union([dq.range_violations(t.clean(tb), tb, rules) for tb, rules in range_rules().items()])


@query("negative_revenue_customers")
def _negative_revenue_customers(t: Tables) -> DataFrame:
    """DQ-2: the violating rows of the revenue rule."""
    return dq.violating_rows(t.clean("customers"), F.col("annual_revenue") >= 0).select(
        "customer_id", "customer_name", "annual_revenue")


@query("orphan_counts")
def _orphan_counts(t: Tables) -> DataFrame:
    """DQ-3: leads / interactions whose customer is unknown (left anti join)."""
    return dq.orphan_counts({"leads": t.clean("leads"), "interactions": t.clean("interactions")},
                            t.clean("customers"))


@query("orphan_leads")
def _orphan_leads(t: Tables) -> DataFrame:
    """DQ-3: the lead rows whose customer is unknown."""
    return dq.orphans(t.clean("leads"), t.clean("customers").where(F.col("annual_revenue") >= 0), "lead_id").select(
        "lead_id", "customer_id")


@query("type_mismatches")
def _type_mismatches(t: Tables) -> DataFrame:
    """DQ-2 (types): declared types of the clean layer against the raw columns."""
    return _union([dq.type_mismatches(t.raw(tb), clean_schema(tb), tb) for tb in QUALITY_SPEC])


@query("cast_violations")
def _cast_violations(t: Tables) -> DataFrame:
    """DQ-2 (values): every raw cell whose text does not read as its declared type."""
    return _union([dq.cast_violations(t.raw(tb), cl.declared_casts(tb), KEYS[tb], tb) for tb in QUALITY_SPEC])


@query("quarantined_leads")
def _quarantined_leads(t: Tables) -> DataFrame:
    """DQ-2: raw leads split in one write; both halves, the quarantined ones with the columns that broke."""
    casts = cl.declared_casts("leads")
    valid, broken = write_split(t.raw("leads"), dq.casts_hold(casts), scratch_path(t.spark, "leads-split"))
    reasons = [F.when(F.col(c).isNotNull() & parsed.isNull(), F.lit(c)) for c, (_, parsed) in casts.items()]
    cells = ("lead_id", "deal_value", "created_at")
    return valid.select(*cells, F.lit(None).cast("string").alias("broken")).unionByName(
        broken.select(*cells, F.concat_ws(",", *reasons).alias("broken")))


@query("distinct_values")
def _distinct_values(t: Tables) -> DataFrame:
    """AG-9: the distinct values of chosen columns, NULL included."""
    return _union([pf.distinct_values(t.clean(tb), c).select(
        F.lit(tb).alias("table_name"), F.lit(c).alias("column_name"), F.col(c).alias("value"))
        for tb, c in (("leads", "status"), ("customers", "account_manager"), ("interactions", "channel_standardized"))])


@query("lead_days")
def _lead_days(t: Tables) -> DataFrame:
    """CL-17: strict day parsing of the raw creation date."""
    return t.raw("leads").select("lead_id", "deal_value", parse_day("created_at").cast("string").alias("created_day"))


@query("completeness")
def _completeness(t: Tables) -> DataFrame:
    """DQ-4 per raw and clean table."""
    return _union([dq.completeness(t.raw(tb), f"raw_{tb}") for tb in QUALITY_SPEC]
                  + [dq.completeness(t.clean(tb), f"clean_{tb}") for tb in QUALITY_SPEC])


@query("volume_growth")
def _volume_growth(t: Tables) -> DataFrame:
    """DQ-5: row change from the raw to the clean layer, per table."""
    counts = _layer_counts(t)
    return dq.volume_growth(counts.withColumnRenamed("raw_rows", "row_count"),
                            counts.withColumnRenamed("clean_rows", "row_count"))


#: The runs of ``run_growth``: the state on two days, as leads' and interactions' dates tell.
RUNS = (("run-1", "1998-01-01", "2024-01-16"), ("run-2", "2030-01-01", "2030-01-01"))


@query("run_growth")
def _run_growth(t: Tables) -> DataFrame:
    """DQ-5: growth between the last two runs of a ledger. The second run is recorded twice and counts once."""
    path = scratch_path(t.spark, "ledger")
    days = stored(_union([
        t.clean("leads").groupBy(F.col("updated_at").alias("day")).agg(F.count(F.lit(1)).alias("n")).select(F.lit("leads").alias("table_name"), "*"),
        t.clean("interactions").groupBy(F.col("interaction_date").alias("day")).agg(F.count(F.lit(1)).alias("n")).select(
            F.lit("interactions").alias("table_name"), "*"),
        t.clean("customers").agg(F.count(F.lit(1)).alias("n")).select(
            F.lit("customers").alias("table_name"), F.lit(None).cast("timestamp_ntz").alias("day"), "n")]), "day-counts")
    for run_id, leads_before, interactions_before in (*RUNS, RUNS[-1]):
        before = F.when(F.col("table_name") == "leads", F.lit(leads_before)).otherwise(F.lit(interactions_before)).cast("timestamp_ntz")
        counts = days.groupBy("table_name").agg(
            F.sum(F.when(F.col("day").isNull() | (F.col("day") < before), F.col("n")).otherwise(0)).alias("row_count"))
        ledger.record_run(counts, path, run_id, _dt.datetime(2024, 2, int(run_id[-1])))
    return ledger.growth_between_runs(ledger.read_ledger(t.spark, path))


@query("unique_customers_sketched")
def _unique_customers_sketched(t: Tables) -> DataFrame:
    """AG-5, opt-in: distinct customers per channel from sketches per day and channel, beside the exact number."""
    clean = t.narrow("interactions", ["customer_id", "channel_standardized", "interaction_date"])
    daily = stored(sk.distinct_sketches(clean, ["interaction_date", "channel_standardized"], "customer_id"), "daily-sketches")
    rolled = sk.rolled_up_distinct(daily, ["channel_standardized"], "estimate")
    exact = clean.groupBy("channel_standardized").agg(F.count_distinct("customer_id").alias("unique_customers"))
    return exact.join(rolled, "channel_standardized").select(
        "channel_standardized", "rows", "unique_customers",
        (F.abs(F.col("estimate") - F.col("unique_customers")) <= F.lit(sk.DISTINCT_ERROR) * F.col("unique_customers")).alias("within_error"))


SKETCHED = {"leads": ("lead_id", ("deal_value",)), "customers": ("customer_id", ("employee_count", "annual_revenue")),
            "interactions": ("interaction_id", ("interaction_time_minutes",))}


@query("sketched_quantiles")
def _sketched_quantiles(t: Tables) -> DataFrame:
    """AG-12, opt-in: quantiles from 16 merged sketches, and whether their ranks lie within the error."""
    parts = []
    for tb, (key, columns) in SKETCHED.items():
        clean = t.narrow(tb, [key, *columns])
        some = stored(sk.quantile_sketches(clean.withColumn("part", F.pmod(F.xxhash64(key), F.lit(16))), ["part"], columns), "quantile-sketches")
        found = sk.rolled_up_quantiles(some, [], columns, (0.05, 0.25, 0.5, 0.75, 0.95))
        parts.append(sk.rank_errors(clean, found, columns).select(
            F.lit(tb).alias("table_name"), "column_name", "quantile", "n", (F.col("rank_error") <= sk.RANK_ERROR).alias("within_error")))
    return _union(parts)


# --- documented-only operators ---------------------------------------------------


@query("normalized_names")
def _normalized_names(t: Tables) -> DataFrame:
    """CL-16: strip special characters from names."""
    return cl.normalize_text(t.clean("customers"), ["customer_name", "industry"]).select(
        "customer_id", "customer_name", "industry")


@query("leads_with_defaults")
def _leads_with_defaults(t: Tables) -> DataFrame:
    """FL-4 + CL-18: drop NULL customer keys, then per-column defaults."""
    leads = cl.drop_missing_keys(t.clean("leads"), ["customer_id"])
    return cl.fill_defaults(leads, {"email": "unknown", "phone": "unknown", "status": "unknown"})


@query("masked_leads")
def _masked_leads(t: Tables) -> DataFrame:
    """CL-19: masked contact data."""
    return cl.mask_contacts(t.clean("leads")).select("lead_id", "email", "phone")


@query("interactions_daily_dedupe")
def _interactions_daily_dedupe(t: Tables) -> DataFrame:
    """DD-3: one interaction per (customer_id, interaction_date)."""
    return dd.keep_first(t.clean("interactions"), ["customer_id", "interaction_date"])


@query("lead_features")
def _lead_features(t: Tables) -> DataFrame:
    """JN-5: leads ⟕ interaction metrics."""
    return ft.lead_features(t.clean("leads"), t.clean("interactions"), dt.AS_OF, BENCH_NOTEBOOK)


@query("weighted_score")
def _weighted_score(t: Tables) -> DataFrame:
    """MT-17: documented weighted score normalised by table maxima."""
    return ft.weighted_score(t.features())


@query("recency_engagement")
def _recency_engagement(t: Tables) -> DataFrame:
    """MT-18: documented engagement with recency."""
    f = t.features()
    return f.select("customer_id", F.round(recency_engagement(
        "num_positive_outcomes", "num_calls", "total_interactions", "days_since_last_interaction"),
        4).alias("recency_engagement"))


@query("channel_conversion")
def _channel_conversion(t: Tables) -> DataFrame:
    """MT-19."""
    return ft.channel_conversion(t.clean("interactions"), t.clean("leads"), BENCH_NOTEBOOK)


@query("channel_response_time")
def _channel_response_time(t: Tables) -> DataFrame:
    """MT-20."""
    return ft.channel_response_time(t.clean("interactions"), t.clean("leads"), BENCH_NOTEBOOK)


@query("daily_trend")
def _daily_trend(t: Tables) -> DataFrame:
    """MT-21 on the daily summary."""
    return ft.daily_trend(agg.sales_summary(t.clean("leads"), BENCH_NOTEBOOK))


@query("hot_leads")
def _hot_leads(t: Tables) -> DataFrame:
    """FL-5 + TK-7: documented SQL over a temp view."""
    return topk.hot_leads(t.spark, t.features(), 10)


# --- lead-scoring model -------------------------------------------------------

from dealspark.operators import boosting, ml  # noqa: E402
from dealspark.session import ensure_checkpoint_dir  # noqa: E402


def _labelled(t: Tables) -> DataFrame:
    return ml.make_label(t.features())


@query("ml_labels")
def _ml_labels(t: Tables) -> DataFrame:
    """ML-1 and ML-2 side by side."""
    f = stored(t.features().select("customer_id", "lead_score", "total_revenue", "total_interactions"), "scores")
    hot = ml.hot_lead_label(f).select("customer_id", F.col(ml.LABEL).alias("score_label"))
    med = ml.median_label(f).select("customer_id", F.col(ml.LABEL).alias("median_label"))
    return hot.join(med, "customer_id")


@query("class_balance")
def _class_balance(t: Tables) -> DataFrame:
    """ML-3."""
    return pf.value_distribution(_labelled(t), ml.LABEL, "customer_features")


@query("ml_feature_matrix")
def _ml_feature_matrix(t: Tables) -> DataFrame:
    """ML-4: available features, NULL → 0."""
    lab = _labelled(t)
    return ml.feature_matrix(lab, "customer_id", ml.available_features(lab))


@query("train_test_split")
def _train_test_split(t: Tables) -> DataFrame:
    """ML-5: exact stratified 80/20 split, seed 42."""
    labels = stored(_labelled(t).select("customer_id", ml.LABEL), "labels")
    return ml.stratified_split(labels, "customer_id").select("customer_id", ml.LABEL, "split")


@query("rule_classifier_report")
def _rule_classifier_report(t: Tables) -> DataFrame:
    """ML-11, ML-13, ML-14 on a fixed rule: predict hot when the conversion
    probability is at least 0.5."""
    pred = _labelled(t).select(
        ml.LABEL, (F.col("probability_to_convert") >= 0.5).cast("int").alias("prediction"))
    return ml.classification_report(pred)


@query("rule_classifier_metrics")
def _rule_classifier_metrics(t: Tables) -> DataFrame:
    """ML-11, ML-13: metrics and confusion cells of the same rule."""
    pred = _labelled(t).select(
        ml.LABEL, (F.col("probability_to_convert") >= 0.5).cast("int").alias("prediction"))
    return ml.binary_metrics(pred)


@query("rule_classifier_auc")
def _rule_classifier_auc(t: Tables) -> DataFrame:
    """ML-12: exact area under the curve of the conversion probability as a score."""
    return ml.roc_auc(_labelled(t).select(ml.LABEL, "probability_to_convert"), score_col="probability_to_convert")


def _checked_model(t: Tables, algorithm: str) -> DataFrame:
    """Train on the train split, save, reload, and score the test split with both.

    The split matrix is written once, so the fit and the scores do not derive
    the features again."""
    ensure_checkpoint_dir(t.spark)
    root = scratch_path(t.spark, "model")
    lab = _labelled(t)
    feats = ml.available_features(lab)
    matrix = stored(ml.feature_matrix(lab, "customer_id", feats), "matrix")
    write_parquet(ml.stratified_split(matrix, "customer_id"), f"{root}/matrix")
    data = t.spark.read.parquet(f"{root}/matrix")
    model = ml.train(data.where(F.col("split") == "train"), feats, algorithm)
    ml.save_model(model, f"{root}/model")
    test = data.where(F.col("split") == "test")
    return ml.consistent_predictions(ml.score(model, test, "customer_id"),
                                     ml.score(ml.load_model(f"{root}/model"), test, "customer_id"), "customer_id")


@query("model_predictions")
def _model_predictions(t: Tables) -> DataFrame:
    """ML-7, ML-9, ML-10, ML-16: boosted trees, scored on the test split."""
    return _checked_model(t, "gbt")


@query("forest_predictions")
def _forest_predictions(t: Tables) -> DataFrame:
    """ML-7, ML-8, ML-10, ML-16: a random forest, scored on the test split."""
    return _checked_model(t, "rf")


# --- report table ---------------------------------------------------------------


@query("analysis_report")
def _analysis_report(t: Tables) -> DataFrame:
    """SNK-4: the analysis report as (section, metric, dimension, value)."""
    clean = {e: stored(t.clean(e), f"clean-{e}") for e in layered.ENTITIES}
    features = stored(ft.eda_customer_features(clean["customers"], clean["interactions"], clean["leads"],
                                               channels=dt.RAW_CHANNELS, profile=BENCH_EDA), "eda-features")
    report = layered.analysis_report(clean["customers"], clean["leads"], clean["interactions"], clean["products"], features)
    unrounded = F.col("metric").isin("mean_lead_score", "mean_engagement_score")
    return report.withColumn("value", F.when(unrounded, F.round("value", 6)).otherwise(F.col("value")))


@query("interaction_summary")
def _interaction_summary(t: Tables) -> DataFrame:
    """AG-16."""
    return ft.interaction_summary(t.clean("interactions"))


@query("channel_pivot")
def _channel_pivot(t: Tables) -> DataFrame:
    """AG-17: a column for each raw channel that occurs."""
    return ft.pivot_counts(t.narrow("interactions", ["customer_id", "channel"]), "channel")


@query("outcome_pivot")
def _outcome_pivot(t: Tables) -> DataFrame:
    """AG-18: a column for each outcome that occurs."""
    return ft.pivot_counts(t.narrow("interactions", ["customer_id", "outcome"]), "outcome", suffix="_outcomes")


@query("deal_summary")
def _deal_summary(t: Tables) -> DataFrame:
    """AG-19 (every deal counts as revenue)."""
    return ft.deal_summary(t.clean("leads"), BENCH_EDA)


from dealspark.plans.profiles import DOC_FLOW  # noqa: E402


@query("doc_flow_scores")
def _doc_flow_scores(t: Tables) -> DataFrame:
    """The documented flow rule set (engagement x25, no cap, unrounded) on the
    same features."""
    feats = t.features().drop("lead_score", "lead_quality", "probability_to_convert")
    scored = ft.score_features(feats, DOC_FLOW.with_(revenue_unit=dt.REVENUE_UNIT))
    return scored.select("customer_id", "lead_score", "lead_quality")


@query("boosted_margins")
def _boosted_margins(t: Tables) -> DataFrame:
    """ML-9: margins after one second-order boosting round (depth 5, rate 0.1) on all labelled customers."""
    lab = stored(_labelled(t), "labelled")
    feats = ml.available_features(lab)
    model = boosting.fit(lab, feats, ml.LABEL, rounds=1)
    return boosting.score(model, lab, "customer_id", ml.LABEL)
