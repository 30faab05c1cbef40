"""The layered pipeline: raw CSV → clean Parquet → curated Parquet, plus the
analysis export and the model training run.

Each step reads its inputs from the previous layer's files and writes its
outputs once. Reading written tables back cuts the lineage between steps,
so a lost executor only recomputes its own step, never the whole chain.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dealspark.operators import aggregate as agg
from dealspark.operators import clean as cl
from dealspark.operators import features as ft
from dealspark.operators import ml
from dealspark.operators import profile as pf
from dealspark.operators import quality as dq
from dealspark.operators import topk
from dealspark.plans.profiles import EDA, NOTEBOOK, ScoringProfile
from dealspark.schemas import KEYS
from dealspark.sources.layers import GOLD_TABLES, Layout
from dealspark.sources.readers import read_bronze, read_parquet
from dealspark.sources.scratch import stored
from dealspark.sources.sinks import publish, save_bucketed, write_csv, write_parquet

ENTITIES = ("leads", "customers", "interactions", "products")


def _ts(run_ts: _dt.datetime | None) -> Column | None:
    return F.lit(run_ts).cast("timestamp") if run_ts is not None else None


# Quality metrics observed while each clean table is written (DQ-1).
QUALITY_SPEC = {
    "leads": dict(null_columns=("email", "phone"), flag_columns=("is_contactable",),
                  range_columns=("deal_value",)),
    "customers": dict(null_columns=("account_manager",), range_columns=("employee_count", "annual_revenue")),
    "interactions": dict(),
    "products": dict(range_columns=("base_price",)),
}


# Columns whose value counts belong to the quality metrics of a clean table.
QUALITY_DISTRIBUTIONS = {"interactions": ("channel", "outcome"), "products": ("category",)}


# Bucket key of each clean table when the layer is written bucketed: the
# curated step aggregates and joins leads, interactions and customers on
# customer_id.
BUCKET_KEYS = {"leads": "customer_id", "customers": "customer_id",
               "interactions": "customer_id", "products": "product_id"}


def silver_table(entity: str, prefix: str = "silver_") -> str:
    return f"{prefix}{entity}_clean"


def bronze_to_silver(spark: SparkSession, layout: Layout, run_ts: _dt.datetime | None = None,
                     entities: Sequence[str] = ENTITIES, buckets: int | None = None,
                     table_prefix: str = "silver_") -> dict[str, str]:
    """Clean every raw entity and replace its clean table (SNK-1): a new
    version is written beside the old one and published when it is whole.

    The quality metrics (DQ-1) are written next to the clean tables: NULL and
    flag counts and min/max come from the written Parquet (a column-pruned
    scan); the raw side only needs a row count, because duplicates removed =
    raw rows - clean rows. No distinct-key shuffle of the raw data is needed.
    (``DataFrame.observe`` would avoid even that count, but on Spark 4.1 an
    observed session can no longer serialise the ML evaluators' closures.)

    With ``buckets``, each clean table is also registered in the catalog,
    bucketed by ``BUCKET_KEYS`` (customer_id for the three tables the
    curated step joins), so ``silver_to_gold(..., bucketed=True)`` runs its
    per-customer aggregates and joins without any shuffle. Use it only when
    no customer holds a large share of rows: one task reads a whole bucket,
    so a hot customer's bucket cannot be split the way the shuffle plan's
    map-side partial aggregation spreads it.
    Returns the written paths.
    """
    out, parts = {}, []
    for e in entities:
        raw = read_bronze(spark, layout.bronze(e), e)
        path = layout.silver(e)
        clean = cl.with_audit(cl.CLEANERS[e](raw), _ts(run_ts))
        if buckets:
            save_bucketed(clean, silver_table(e, table_prefix), path, BUCKET_KEYS[e], buckets)
        else:
            publish(clean, path)
        out[e] = path
        stats = read_parquet(spark, path).agg(*dq.clean_metric_columns(**QUALITY_SPEC.get(e, {})))
        stats = stats.withColumn("raw_rows", raw.agg(F.count(F.lit(1))).scalar()).withColumn(
            "duplicates_removed", F.col("raw_rows") - F.col("clean_rows"))
        names = ["raw_rows", "duplicates_removed"] + [c for c in stats.columns
                                                       if c not in ("raw_rows", "duplicates_removed")]
        structs = [F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("value")) for m in names]
        parts.append(stats.select(F.explode(F.array(*structs)).alias("s")).select(
            F.lit(e).alias("table_name"), "s.metric", "s.value"))
        if e in QUALITY_DISTRIBUTIONS:
            parts.append(dq.distribution_metrics(
                pf.value_distributions(read_parquet(spark, path), QUALITY_DISTRIBUTIONS[e], e)))
    report = parts[0]
    for p in parts[1:]:
        report = report.unionByName(p)
    qpath = layout.silver("_quality")
    publish(report, qpath)
    out["_quality"] = qpath
    return out


def read_silver(spark: SparkSession, layout: Layout, entity: str, bucketed: bool = False,
                table_prefix: str = "silver_") -> DataFrame:
    """SRC-2: a clean table without its audit column (from the catalog when
    the layer was written bucketed, so the bucketing is known to the planner)."""
    df = (spark.table(silver_table(entity, table_prefix)) if bucketed
          else read_parquet(spark, layout.silver(entity)))
    return df.drop("processed_at") if "processed_at" in df.columns else df


def silver_to_gold(spark: SparkSession, layout: Layout, as_of: _dt.date,
                   profile: ScoringProfile = NOTEBOOK, run_ts: _dt.datetime | None = None,
                   top_n: int = 50, bucketed: bool = False,
                   table_prefix: str = "silver_") -> dict[str, str]:
    """Build and publish the four curated tables (SNK-2).

    ``top_customers`` is read from the written feature table instead of
    re-deriving the features from the clean layer.
    """
    leads, customers, interactions = (read_silver(spark, layout, e, bucketed, table_prefix)
                                      for e in ("leads", "customers", "interactions"))
    ts = _ts(run_ts)
    paths = {t: layout.gold(t) for t in GOLD_TABLES}
    publish(cl.with_audit(ft.customer_features(customers, interactions, leads, as_of, profile), ts),
                  paths["customer_features"])
    publish(cl.with_audit(agg.sales_summary(leads, profile), ts), paths["sales_summary"])
    publish(cl.with_audit(agg.channel_performance(interactions, profile), ts),
                  paths["channel_performance"])
    feats = read_parquet(spark, paths["customer_features"])
    publish(cl.with_audit(topk.top_customers(feats, top_n), ts), paths["top_customers"])
    return paths


def analysis_report(customers: DataFrame, leads: DataFrame, interactions: DataFrame,
                    products: DataFrame, eda_features: DataFrame) -> DataFrame:
    """SNK-4: the analysis report as one long table
    ``(section, metric, dimension, value)`` — a union of small aggregates.

    Every distribution is computed once and exploded into its metric rows
    (count, value, share), so no sub-plan appears twice in the union.
    """

    def rows(section: str, df: DataFrame, dim: Column | None, metrics: dict[str, str]) -> DataFrame:
        structs = [F.struct(F.lit(m).alias("metric"), F.col(c).cast("double").alias("value"))
                   for m, c in metrics.items()]
        d = (dim if dim is not None else F.lit("")).cast("string").alias("dimension")
        return df.select(d, F.explode(F.array(*structs)).alias("s")).select(
            F.lit(section).alias("section"), "s.metric", "dimension", "s.value")

    def count_row(name: str, df: DataFrame) -> DataFrame:
        return rows("summary", df.agg(F.count(F.lit(1)).alias("n")), None, {f"total_{name}": "n"})

    def described(section: str, df: DataFrame, spec, metric) -> DataFrame:
        d = pf.describe_columns(df, section, spec)
        return d.select(F.lit(section).alias("section"), metric.alias("metric"),
                        F.lit("").alias("dimension"), "value")

    def top_rows() -> DataFrame:
        """The ten best leads: each value of a row has the rank as its dimension and, where it is text, its label."""
        top = topk.top_by_lead_score(eda_features, 10)
        fields = [("top_customer", F.col("customer_name"), F.lit(None).cast("double")),
                  ("top_customer_id", F.col("customer_id"), F.lit(None).cast("double")),
                  ("top_quality", F.col("lead_quality"), F.lit(None).cast("double")),
                  ("top_lead_score", F.lit(None).cast("string"), F.col("lead_score").cast("double")),
                  ("top_revenue", F.lit(None).cast("string"), F.col("total_revenue").cast("double"))]
        cells = [F.struct(F.lit(m).alias("metric"), t.alias("label"), v.alias("value")) for m, t, v in fields]
        return top.select(F.col("rank").cast("string").alias("dimension"), F.explode(F.array(*cells)).alias("s")).select(
            F.lit("features").alias("section"), "s.metric",
            F.concat_ws(": ", "dimension", "s.label").alias("dimension"), "s.value")

    stat_col = F.concat(F.col("stat"), F.lit("_"), F.col("column_name"))
    idist = pf.value_distributions(interactions, ["channel", "outcome"])
    parts = [
        count_row("customers", customers), count_row("leads", leads),
        count_row("interactions", interactions), count_row("products", products),
        described("leads", leads, {"deal_value": ("sum", "mean", "median")}, stat_col),
        rows("leads", pf.status_breakdown(leads), F.col("status"),
             {"status_deals": "deals", "status_deal_value": "deal_value", "status_pct": "pct"}),
        rows("leads", pf.value_distribution(leads, "source"), F.col("value"),
             {"source_leads": "count", "source_pct": "pct"}),
        described("customers", customers, {"annual_revenue": ("sum",),
                                           "employee_count": ("mean", "max", "min")}, stat_col),
        rows("customers", pf.top_values(customers, "industry", 5), F.col("value"),
             {"top_industry_customers": "count", "top_industry_pct": "pct"}),
        described("interactions", interactions, {"interaction_time_minutes": ("mean",)},
                  F.lit("mean_duration_minutes")),
        rows("interactions", idist.where(F.col("column_name") == "channel"), F.col("value"),
             {"channel_interactions": "count", "channel_pct": "pct"}),
        rows("interactions", idist.where(F.col("column_name") == "outcome"), F.col("value"),
             {"outcome_interactions": "count", "outcome_pct": "pct"}),
        rows("features", pf.feature_summary(eda_features), None,
             {m: m for m in ("mean_lead_score", "median_lead_score", "max_lead_score",
                             "mean_engagement_score", "mean_total_interactions", "mean_total_revenue")}),
        rows("features", pf.quality_distribution(eda_features), F.col("lead_quality"),
             {"quality_customers": "customers", "quality_pct": "pct"}),
        top_rows(),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def analysis(spark: SparkSession, layout: Layout, out_root: str,
             channels: Sequence[str] | None = None,
             profile: ScoringProfile = EDA) -> dict[str, str]:
    """The analysis run: analysis-rule features as CSV (SNK-3), with a column
    for every channel that occurs unless ``channels`` fixes them, and the
    report table (SNK-4) as Parquet, both from the clean layer."""
    c, l, i, p = (read_silver(spark, layout, e) for e in ("customers", "leads", "interactions", "products"))
    # derived and written once; the export and every part of the report read it
    feats = stored(ft.eda_customer_features(c, i, l, channels=channels, profile=profile), "eda-features")
    fpath, rpath = f"{out_root.rstrip('/')}/customer_features_csv", f"{out_root.rstrip('/')}/report"
    write_csv(feats, fpath)
    publish(analysis_report(c, l, i, p, feats), rpath)
    return {"features_csv": fpath, "report": rpath}


def train_lead_model(spark: SparkSession, features: DataFrame, model_path: str,
                     id_col: str = "customer_id", prefer: str = "gbt", seed: int = 42):
    """ML run: label, split, train RF and GBT, evaluate both, pick one
    (ML-15), save it, reload it and evaluate the reloaded model (ML-16).

    Returns ``(model_name, metrics DataFrame)``; metrics hold one row per
    model plus ``reloaded``.
    """
    lab = ml.make_label(features)
    feats = ml.available_features(lab)
    split = ml.stratified_split(stored(ml.feature_matrix(lab, id_col, feats), "matrix"), id_col, seed=seed)
    matrix = f"{model_path.rstrip('/')}_matrix"
    write_parquet(split, matrix)  # both fits and all scores read it instead of deriving the features again
    data = read_parquet(spark, matrix)
    train_df, test_df = data.where(F.col("split") == "train"), data.where(F.col("split") == "test")
    models, rows, aucs = {}, [], {}
    for name in ("rf", "gbt"):
        models[name] = ml.train(train_df, feats, name, seed)
        pred = ml.score(models[name], test_df, id_col)
        aucs[name] = ml.roc_auc(pred).first()["roc_auc"]
        rows.append(ml.binary_metrics(pred).withColumn("model", F.lit(name)).withColumn(
            "roc_auc", F.lit(aucs[name]).cast("double")))
    best = ml.select_model(aucs, prefer)
    ml.save_model(models[best], model_path)
    reloaded = ml.load_model(model_path)
    pred = ml.score(reloaded, test_df, id_col)
    rows.append(ml.binary_metrics(pred).withColumn("model", F.lit("reloaded")).withColumn(
        "roc_auc", ml.roc_auc(pred).select("roc_auc").scalar()))
    out = rows[0]
    for r in rows[1:]:
        out = out.unionByName(r)
    return best, out
