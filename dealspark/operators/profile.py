"""Profiling and analysis tables (AG-7..24, TK-5, TK-6, SNK-4).

The analysis script printed these; here each is a small DataFrame computed
by one aggregate pass over the table (no per-value job loops, no collect).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dealspark.functions.numeric import exact_avg, exact_sum
from dealspark.operators.select import ranked_band

def _double(c: str) -> Column:
    return F.col(c).cast("double")


def column_stats(df: DataFrame, table: str, columns: Sequence[str]) -> DataFrame:
    """AG-7: min / max / mean / sum of numeric columns, one row per column,
    from ONE aggregate pass (then unpivoted). Sums as in ``exact_sum``."""
    aggs = []
    for c in columns:
        aggs += [F.min(_double(c)).alias(f"{c}__min"), F.max(_double(c)).alias(f"{c}__max"),
                 exact_avg(_double(c)).alias(f"{c}__avg"), exact_sum(_double(c)).alias(f"{c}__sum")]
    wide = df.agg(*aggs)
    rows = [F.struct(F.lit(c).alias("column_name"), F.col(f"{c}__min").alias("min_value"),
                     F.col(f"{c}__max").alias("max_value"), F.col(f"{c}__avg").alias("mean_value"),
                     F.col(f"{c}__sum").alias("sum_value")) for c in columns]
    return wide.select(F.explode(F.array(*rows)).alias("s")).select(
        F.lit(table).alias("table_name"), "s.*")


def row_counts(frames: Mapping[str, DataFrame]) -> DataFrame:
    """AG-8: rows per table, as one union of global counts."""
    parts = [df.agg(F.count(F.lit(1)).alias("row_count")).select(
        F.lit(name).alias("table_name"), "row_count") for name, df in frames.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    """AG-9: the distinct values of a column (NULL included)."""
    return df.select(column).distinct()


def value_distribution(df: DataFrame, column: str, table: str = "") -> DataFrame:
    """AG-10 / FL-2: value, count and percentage of *all* rows (NULL rows
    count in the denominator but are not listed).

    One grouped count; the total is a global sum over the (small) grouped
    result, so no second pass over the table is needed.
    """
    counts = df.groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("count"))
    total = counts.agg(F.sum("count")).scalar()
    return counts.withColumn("pct", F.col("count") * F.lit(100.0) / total).where(
        F.col("value").isNotNull()).select(
        F.lit(table).alias("table_name"), F.lit(column).alias("column_name"),
        F.col("value").cast("string").alias("value"), "count", "pct")


def most_frequent_first(distribution: DataFrame) -> DataFrame:
    """TK-6: value counts per column, the most frequent first (ties by value).
    To be applied once, after the distributions to show are united."""
    return distribution.orderBy("table_name", "column_name", F.col("count").desc(), F.col("value").asc())


def value_distributions(df: DataFrame, columns: Sequence[str], table: str = "") -> DataFrame:
    """AG-10 for several columns of one table in ONE scan and ONE shuffle:
    (column, value) pairs are exploded per row and counted together; the
    denominator (all rows of the table) is one scalar count."""
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"),
                                         F.col(c).cast("string").alias("value")) for c in columns]))
    counts = df.select(pairs.alias("p")).groupBy("p.column_name", "p.value").agg(
        F.count(F.lit(1)).alias("count"))
    total = df.agg(F.count(F.lit(1))).scalar()
    return counts.where(F.col("value").isNotNull()).select(
        F.lit(table).alias("table_name"), "column_name", "value", "count",
        (F.col("count") * F.lit(100.0) / total).alias("pct"))


def null_profile(df: DataFrame, table: str) -> DataFrame:
    """AG-11: NULL count and percentage per column, only columns with NULLs."""
    aggs = [F.count(F.lit(1)).alias("__n")] + [
        F.count_if(F.col(c).isNull()).alias(c) for c in df.columns]
    wide = df.agg(*aggs)
    rows = [F.struct(F.lit(c).alias("column_name"), F.col(c).alias("null_count")) for c in df.columns]
    return wide.select("__n", F.explode(F.array(*rows)).alias("s")).select(
        F.lit(table).alias("table_name"), "s.column_name", "s.null_count",
        (F.col("s.null_count") * F.lit(100.0) / F.col("__n")).alias("null_pct")).where(
        F.col("null_count") > 0)


def exact_medians(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Exact interpolated medians of several columns (NULLs skipped, NaN above
    all numbers), one row ``(column_name, median)`` per column that has values.

    (column, value) pairs are exploded per row, and ``ranked_band`` narrows
    each column to the few values around its middle rank with bucket counts,
    so no column, sketch or hot value is gathered in one task.
    """
    pairs = df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column_name"), _double(c).alias("x")) for c in columns])).alias("p")
    ).select("p.column_name", "p.x").where(F.col("x").isNotNull())
    # order-preserving and even over magnitudes: every double lies within +-711
    place = F.when(F.isnan("x"), F.lit(712.0)).otherwise(F.least(F.greatest(F.asinh("x"), F.lit(-711.0)), F.lit(711.0)))
    low, high = F.floor((F.col("n") + 1) / 2), F.floor(F.col("n") / 2) + 1
    band = ranked_band(pairs.withColumn("g", place), "column_name", "g", "x", -712.0, 713.0, low, high)
    w = Window.partitionBy("column_name").orderBy("x").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    cum = band.select("*", (F.sum("c").over(w) + F.col("below")).alias("upto"))
    picked = cum.groupBy("column_name").agg(
        F.min(F.when(F.col("upto") >= F.col("low"), F.col("x"))).alias("xl"),
        F.min(F.when(F.col("upto") >= F.col("high"), F.col("x"))).alias("xu"),
        F.max("upto").alias("reached"), F.max("high").alias("high"), F.min("below").alias("below"),
        F.min("low").alias("low"))
    held = (F.col("below") < F.col("low")) & (F.col("reached") >= F.col("high"))
    med = F.when(F.col("xl") == F.col("xu"), F.col("xl")).otherwise(0.5 * F.col("xl") + 0.5 * F.col("xu"))
    return picked.select("column_name", F.when(held, med).otherwise(
        F.raise_error(F.lit("median rank outside its band")).cast("double")).alias("median"))


def exact_median(df: DataFrame, column: str) -> DataFrame:
    """Exact median of one column as a one-row ``median`` table (NULL when the
    column has no values); see ``exact_medians``."""
    m = exact_medians(df, [column]).select("median").scalar()
    return df.sparkSession.range(1).select(m.alias("median"))


def describe_columns(df: DataFrame, table: str, spec: Mapping[str, Sequence[str]]) -> DataFrame:
    """AG-12: chosen statistics per column, long form (table, column, stat, value).

    ``spec`` maps a column to a subset of sum / mean / median / min / max.
    Sums and means of money are exact decimal sums (order-independent); all
    medians of the table share the two passes of ``exact_medians``.
    """
    parts = []
    simple = []
    median_cols = []
    for c, stats in spec.items():
        x = _double(c)
        fn = {"sum": exact_sum(x), "mean": exact_avg(x), "min": F.min(x), "max": F.max(x)}
        for s in stats:
            if s == "median":
                median_cols.append(c)
            else:
                simple.append((c, s, fn[s]))
    if simple:
        wide = df.agg(*[e.alias(f"{c}__{s}") for c, s, e in simple])
        rows = [F.struct(F.lit(c).alias("column_name"), F.lit(s).alias("stat"),
                         F.col(f"{c}__{s}").alias("value")) for c, s, _ in simple]
        parts.append(wide.select(F.explode(F.array(*rows)).alias("s")).select("s.*"))
    if median_cols:
        parts.append(exact_medians(df, median_cols).select(
            "column_name", F.lit("median").alias("stat"), F.col("median").alias("value")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.select(F.lit(table).alias("table_name"), "column_name", "stat", "value")


def sum_by(df: DataFrame, key: str, value: str, alias: str) -> DataFrame:
    """AG-13 / AG-15: exact sum of a money column per key, largest first
    (NULL keys dropped, as pandas groupby does)."""
    return df.where(F.col(key).isNotNull()).groupBy(key).agg(
        exact_sum(value).alias(alias)).orderBy(
        F.col(alias).desc(), F.col(key).asc())


def status_breakdown(leads: DataFrame) -> DataFrame:
    """AG-14: per status: deals, deal value, share of all leads."""
    per = leads.groupBy("status").agg(
        F.count(F.lit(1)).alias("deals"),
        exact_sum("deal_value").alias("deal_value"))
    total = per.agg(F.sum("deals")).scalar()
    return per.withColumn("pct", F.col("deals") * F.lit(100.0) / total).where(
        F.col("status").isNotNull())


def by_value_first(breakdown: DataFrame) -> DataFrame:
    """TK-6: statuses by deal value, largest first, with their rank."""
    order = Window.orderBy(F.col("deal_value").desc_nulls_last(), F.col("status").asc())  # one row per status
    return breakdown.withColumn("revenue_rank", F.row_number().over(order)).orderBy("revenue_rank")


def date_range(df: DataFrame, table: str, columns: Sequence[str]) -> DataFrame:
    """AG-7 for dates: first and last value per column, in one pass."""
    wide = df.agg(*[f(c).alias(f"{c}__{n}") for c in columns for n, f in (("min", F.min), ("max", F.max))])
    rows = [F.struct(F.lit(c).alias("column_name"), F.col(f"{c}__min").alias("first_value"),
                     F.col(f"{c}__max").alias("last_value")) for c in columns]
    return wide.select(F.explode(F.array(*rows)).alias("s")).select(F.lit(table).alias("table_name"), "s.*")


def top_values(df: DataFrame, column: str, n: int, table: str = "") -> DataFrame:
    """TK-5: the n most frequent values with their percentage (ties by value)."""
    return value_distribution(df, column, table).orderBy(F.col("count").desc(), F.col("value").asc()).limit(n)


# Quality labels in report order.
QUALITY_ORDER = ("hot", "warm", "cool", "cold")


def quality_distribution(features: DataFrame, labels: Sequence[str] = QUALITY_ORDER) -> DataFrame:
    """AG-20: count and percentage of customers per quality label in a fixed
    order, with zero rows for absent labels (a literal dimension ⟕ counts)."""
    spark = features.sparkSession
    dim = spark.createDataFrame([(i, q) for i, q in enumerate(labels)], "position int, lead_quality string")
    counts = features.groupBy("lead_quality").agg(F.count(F.lit(1)).alias("customers"))
    total = features.agg(F.count(F.lit(1))).scalar()
    n = F.coalesce(F.col("customers"), F.lit(0))
    return (F.broadcast(dim).join(counts, "lead_quality", "left")
            .select("position", "lead_quality", n.alias("customers"),
                    F.coalesce(F.try_divide(n * F.lit(100.0), total), F.lit(0.0)).alias("pct"))
            .orderBy("position"))


def feature_summary(features: DataFrame) -> DataFrame:
    """AG-21: mean / median / max lead score; mean engagement, interactions, revenue."""
    one = features.agg(
        F.avg("lead_score").alias("mean_lead_score"),
        F.max("lead_score").alias("max_lead_score"),
        F.avg("engagement_score").alias("mean_engagement_score"),
        F.avg(F.col("total_interactions").cast("double")).alias("mean_total_interactions"),
        exact_avg("total_revenue").alias("mean_total_revenue"))
    med = exact_median(features, "lead_score").select("median").scalar()
    return one.withColumn("median_lead_score", med)


def score_histogram(features: DataFrame, column: str = "lead_score", bins: int = 15) -> DataFrame:
    """AG-22: equal-width histogram over [min, max], last bin closed; every bin
    listed (empty ones with 0). min and max are one scalar subquery."""
    x = _double(column)
    ends = features.agg(F.struct(F.min(x).alias("lo"), F.max(x).alias("hi"))).scalar()
    placed = features.where(x.isNotNull()).select(x.alias("x"), ends.alias("e"))
    width = (F.col("e.hi") - F.col("e.lo")) / F.lit(float(bins))
    b = F.when(F.col("e.hi") == F.col("e.lo"), F.lit(0)).otherwise(
        F.least(F.floor((F.col("x") - F.col("e.lo")) / width).cast("int"), F.lit(bins - 1)))
    counts = placed.groupBy("e", b.alias("bin")).agg(F.count(F.lit(1)).alias("customers"))
    # one row with a list of at most ``bins`` counts, dealt to all bins
    listed = counts.groupBy("e").agg(F.map_from_entries(F.collect_list(F.struct("bin", "customers"))).alias("found"))
    each = listed.select("e", "found", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    edge = lambda k: F.col("e.lo") + k * (F.col("e.hi") - F.col("e.lo")) / F.lit(float(bins))
    return each.select("bin", edge(F.col("bin")).alias("bin_start"), edge(F.col("bin") + 1).alias("bin_end"),
                       F.coalesce(F.try_element_at("found", F.col("bin")), F.lit(0).cast("long")).alias("customers")).orderBy("bin")


def scatter_points(df: DataFrame, key: str, x: str, y: str, color: str | None = None) -> DataFrame:
    """AG-23: the point set behind a scatter chart."""
    cols = [key, x, y] + ([color] if color else [])
    return df.select(*cols)


def summary_table(df: DataFrame, *stats: str) -> DataFrame:
    """AG-24 (documented): Spark's ``summary()`` of a table."""
    return df.summary(*stats) if stats else df.summary()
