"""Customer feature tables (MT-15, MT-16, JN-1..5) and documented metrics
(MT-17, MT-19, MT-20, MT-21).

Joins happen only after both sides are aggregated to customer grain, so a
customer with a third of all interactions or deals is one row at join time.
The aggregates come out hash-partitioned by ``customer_id``; the customer
dimension is the only side that still needs an exchange for a sort-merge
join, and AQE turns a join into a broadcast only from runtime sizes.
"""

from __future__ import annotations

import datetime as _dt
import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dealspark.functions.numeric import exact_avg, exact_sum, smoothed_ratio
from dealspark.operators.skew import salted_join
from dealspark.functions.scoring import (
    engagement_score,
    lead_score,
    probability_to_convert,
    quality_band,
)
from dealspark.operators.aggregate import WON, LOST, deal_metrics, interaction_metrics
from dealspark.plans.profiles import DOC_WEIGHTED, EDA, NOTEBOOK, ScoringProfile

CUSTOMER_COLUMNS = (
    "customer_id", "customer_name", "industry", "country", "city", "employee_count",
    "annual_revenue", "account_manager", "created_at",
)

# Defaults for customers without interactions / deals.
INTERACTION_DEFAULTS = {
    "total_interactions": 0, "num_calls": 0, "num_whatsapp": 0, "num_emails": 0,
    "num_positive_outcomes": 0, "num_negative_outcomes": 0, "engagement_score": 0.0,
    "preferred_channel": "email", "days_since_last_interaction": 999,
}
DEAL_DEFAULTS = {
    "total_revenue": 0.0, "num_closed_won": 0, "num_closed_lost": 0, "num_open_deals": 0,
    "conversion_rate": 0.0, "win_rate": 0.0, "avg_deal_value": 0.0,
}


def _default(name: str, value) -> F.Column:
    return F.coalesce(F.col(name), F.lit(value)).alias(name)


def customer_features(customers: DataFrame, interactions: DataFrame, leads: DataFrame,
                      as_of: _dt.date, profile: ScoringProfile = NOTEBOOK) -> DataFrame:
    """MT-15 (flagship): customers ⟕ interaction metrics ⟕ deal metrics, scored.

    25 selected columns + lead_score, lead_quality, probability_to_convert.
    """
    im = interaction_metrics(interactions, as_of, profile)
    dm = deal_metrics(leads, profile)
    joined = (customers.select(*CUSTOMER_COLUMNS)
              .join(im, "customer_id", "left")
              .join(dm, "customer_id", "left"))
    feats = joined.select(
        *CUSTOMER_COLUMNS,
        *[_default(k, v) for k, v in INTERACTION_DEFAULTS.items()],
        *[_default(k, v) for k, v in DEAL_DEFAULTS.items()],
    )
    return score_features(feats, profile)


def weighted_lead_score(feats: DataFrame, profile: ScoringProfile) -> F.Column:
    """MT-17: the documented weighted score. Revenue and interactions are
    divided by their table maxima (scalar subqueries, one merged aggregate
    pass) and scaled to 100; win rate is scaled to 100; rounded to 2."""
    max_rev = feats.agg(F.max("total_revenue")).scalar()
    max_n = feats.agg(F.max("total_interactions")).scalar()
    p = profile
    score = (F.coalesce(F.try_divide(F.col("total_revenue"), max_rev), F.lit(0.0)) * F.lit(100) * F.lit(p.revenue_points)
             + F.coalesce(F.try_divide(F.col("total_interactions"), max_n), F.lit(0.0)) * F.lit(100) * F.lit(p.interaction_points)
             + F.col("engagement_score") * F.lit(p.engagement_points)
             + F.col("win_rate") * F.lit(100) * F.lit(p.win_points))
    return F.round(score, 2)


def score_features(feats: DataFrame, profile: ScoringProfile = NOTEBOOK) -> DataFrame:
    """MT-10..12 (or MT-17 for a max-normalised profile) on a feature table:
    lead_score, lead_quality, probability_to_convert."""
    if profile.normalize_by_max:
        score = weighted_lead_score(feats, profile)
    else:
        score = lead_score("total_revenue", "total_interactions", "engagement_score", "win_rate", profile)
    scored = feats.withColumn("lead_score", score)
    return scored.withColumns({
        "lead_quality": quality_band("lead_score", profile),
        "probability_to_convert": probability_to_convert("engagement_score", "conversion_rate", profile),
    })


def _pivot_name(prefix: str, value: str, suffix: str = "") -> str:
    return prefix + re.sub(r"[^0-9A-Za-z]+", "_", value).strip("_").lower() + suffix


def pivot_count_columns(column: str, values: Sequence[str], prefix: str = "num_",
                        suffix: str = "") -> list[F.Column]:
    """Conditional counts per value — what ``pivot(column, values).count()``
    computes — as aggregate expressions that can share one pass."""
    return [F.count_if(F.col(column) == F.lit(v)).alias(_pivot_name(prefix, v, suffix)) for v in values]


#: Values of a pivot column at most: each becomes a column of the result.
MAX_PIVOT_VALUES = 1000


def occurring_values(df: DataFrame, column: str, limit: int = MAX_PIVOT_VALUES) -> list[str]:
    """AG-17 / AG-18, first phase: the values that occur in ``column``,
    ascending, without NULL. More than ``limit`` of them are an error, never
    a shorter list, and so are two values that would share a column name."""
    values = df.where(F.col(column).isNotNull()).select(F.col(column).cast("string").alias("v")).distinct()
    found = values.limit(limit + 1).agg(F.collect_list("v")).first()[0]  # one row, bounded by the limit
    if len(found) > limit:
        raise ValueError(f"{column!r} has over {limit} values; pivot a column with fewer, or raise the limit")
    names = {}
    for v in sorted(found):
        if names.setdefault(_pivot_name("", v, ""), v) != v:
            raise ValueError(f"values {names[_pivot_name('', v, '')]!r} and {v!r} of {column!r} give one column name")
    return sorted(found)


def interaction_summary(interactions: DataFrame) -> DataFrame:
    """AG-16: per customer — count of interaction ids, mean minutes, last date
    (NULL customers dropped, as pandas groupby does)."""
    return interactions.where(F.col("customer_id").isNotNull()).groupBy("customer_id").agg(
        *_summary_columns())


def pivot_counts(interactions: DataFrame, column: str, values: Sequence[str] | None = None,
                 prefix: str = "num_", suffix: str = "") -> DataFrame:
    """AG-17 / AG-18: per customer, one count column per value (missing = 0),
    e.g. ``num_<channel>`` or ``num_<outcome>_outcomes``. Without ``values``,
    every value that occurs gets its column (``occurring_values``); a given
    list fixes the schema and counts these values alone."""
    known = interactions.where(F.col("customer_id").isNotNull())
    values = occurring_values(known, column) if values is None else values
    if not values:
        return known.select("customer_id").distinct()
    return known.groupBy("customer_id").agg(*pivot_count_columns(column, values, prefix, suffix))


def deal_summary(leads: DataFrame, profile: ScoringProfile = EDA) -> DataFrame:
    """AG-19: per customer — revenue (every deal by default), non-NULL deal
    count, mean deal value and won count."""
    return leads.where(F.col("customer_id").isNotNull()).groupBy("customer_id").agg(
        *_deal_summary_columns(profile))


def _summary_columns() -> list[F.Column]:
    return [F.count("interaction_id").alias("total_interactions"),
            F.avg("interaction_time_minutes").alias("avg_interaction_duration"),
            F.max("interaction_date").alias("last_interaction_date")]


def _deal_summary_columns(profile: ScoringProfile) -> list[F.Column]:
    statuses = profile.revenue_statuses
    rev = F.col("deal_value") if statuses is None else F.when(
        F.col("status").isin(*statuses), F.col("deal_value"))
    return [exact_sum(rev).alias("total_revenue"),
            F.count("deal_value").alias("total_deals"),
            exact_avg("deal_value").alias("avg_deal_value"),
            F.count_if(F.col("status") == F.lit(WON)).alias("num_closed_won")]


def eda_customer_features(customers: DataFrame, interactions: DataFrame, leads: DataFrame,
                          channels: Sequence[str] | None = ("call", "email", "whatsapp"),
                          outcomes: Sequence[str] | None = ("negative", "neutral", "positive"),
                          profile: ScoringProfile = EDA) -> DataFrame:
    """MT-16: the analysis script's feature table (AG-16..19, JN-4, MT-13, MT-14).
    ``channels`` or ``outcomes`` of None: a column for every value that occurs.

    AG-16, AG-17 and AG-18 are computed in ONE aggregate over interactions
    (their column builders are shared with the standalone operators above),
    so the table costs one shuffle of interactions and one of leads instead
    of four. Revenue counts every deal; numeric gaps after the joins become
    0, while ``last_interaction_date`` stays NULL in a typed table.
    """
    ch = profile.channel_column
    known = interactions.where(F.col("customer_id").isNotNull())
    channels = occurring_values(known, ch) if channels is None else channels
    outcomes = occurring_values(known, "outcome") if outcomes is None else outcomes
    isum = known.groupBy("customer_id").agg(
        *_summary_columns(),
        *pivot_count_columns(ch, channels),
        *pivot_count_columns("outcome", outcomes, suffix="_outcomes"),
    )
    deals = deal_summary(leads, profile)
    joined = (customers.select(*CUSTOMER_COLUMNS)
              .join(isum, "customer_id", "left")
              .join(deals, "customer_id", "left"))
    numeric = [f.name for f in joined.schema.fields
               if f.name not in CUSTOMER_COLUMNS and f.dataType.typeName() in ("long", "double", "integer")]
    filled = joined.fillna(0, subset=numeric)
    pos = _pivot_name("num_", "positive", "_outcomes")
    neg = _pivot_name("num_", "negative", "_outcomes")
    pos_c = F.col(pos) if pos in filled.columns else F.lit(0)
    neg_c = F.col(neg) if neg in filled.columns else F.lit(0)
    eng = engagement_score(pos_c, F.col("total_interactions"), neg_c, profile)
    scored = filled.withColumn("engagement_score", eng)
    win = smoothed_ratio(F.col("num_closed_won"), F.col("total_deals"), profile.smoothing)
    scored = scored.withColumn("lead_score", lead_score(
        "total_revenue", "total_interactions", "engagement_score", win, profile))
    return scored.withColumn("lead_quality", quality_band("lead_score", profile))


def lead_features(leads: DataFrame, interactions: DataFrame, as_of: _dt.date,
                  profile: ScoringProfile = NOTEBOOK) -> DataFrame:
    """JN-5 (documented): each lead ⟕ its customer's interaction metrics. The
    join is salted, so a customer with a third of all leads spreads over tasks."""
    im = interaction_metrics(interactions, as_of, profile).select(
        "customer_id", "total_interactions", "num_calls", "num_positive_outcomes",
        "num_negative_outcomes", "engagement_score", "preferred_channel",
        "days_since_last_interaction")
    own = leads.select("lead_id", "customer_id", "deal_value", "status", "source")
    return salted_join(own, im, "customer_id", "left", "lead_id").select(
        "lead_id", "customer_id", "deal_value", "status", "source",
        _default("total_interactions", 0), _default("num_calls", 0),
        _default("num_positive_outcomes", 0), _default("num_negative_outcomes", 0),
        _default("engagement_score", 0.0), _default("preferred_channel", "email"),
        _default("days_since_last_interaction", 999))


def weighted_score(features: DataFrame) -> DataFrame:
    """MT-17 (documented): 0.30*rev/max(rev)*100 + 0.20*n/max(n)*100
    + 0.25*engagement + 0.25*win_rate*100, banded 80/60/40 — the DOC_WEIGHTED
    rule set applied to an existing feature table."""
    return features.select("customer_id", weighted_lead_score(features, DOC_WEIGHTED).alias(
        "weighted_score")).withColumn("weighted_quality", quality_band("weighted_score", NOTEBOOK))


def channel_conversion(interactions: DataFrame, leads: DataFrame,
                       profile: ScoringProfile = NOTEBOOK) -> DataFrame:
    """MT-19 (documented; definition ours): per standardised channel, over the
    customers that used it, won/(won+lost) and the mean deal value.

    (customer, channel) pairs are deduplicated by a grouped aggregate and
    joined to per-customer deal sums, so the join is at customer grain.
    """
    ch = profile.channel_column
    users = interactions.where(F.col("customer_id").isNotNull()).select(ch, "customer_id").distinct()
    per_cust = leads.where(F.col("customer_id").isNotNull()).groupBy("customer_id").agg(
        F.count_if(F.col("status") == F.lit(WON)).alias("won"),
        F.count_if(F.col("status") == F.lit(LOST)).alias("lost"),
        exact_sum("deal_value").alias("deal_sum"),
        F.count("deal_value").alias("deals"),
    )
    j = users.join(per_cust, "customer_id", "inner")
    agg = j.groupBy(ch).agg(
        F.count(F.lit(1)).alias("customers_with_deals"),
        F.sum("won").alias("won"), F.sum("lost").alias("lost"),
        exact_sum("deal_sum").alias("deal_sum"), F.sum("deals").alias("deals"))
    return agg.select(
        ch, "customers_with_deals", "won", "lost",
        F.round(F.try_divide(F.col("won"), F.col("won") + F.col("lost")), 4).alias("channel_conversion_rate"),
        F.round(F.try_divide(F.col("deal_sum"), F.col("deals")), 2).alias("avg_deal_value"),
    )


def channel_response_time(interactions: DataFrame, leads: DataFrame,
                          profile: ScoringProfile = NOTEBOOK) -> DataFrame:
    """MT-20 (documented; definition ours): mean days from a lead's creation to
    the customer's first interaction on that channel on or after that day.
    Leads without a later contact on a channel are not counted for it.

    No lead × contact pairs are built. Both sides are reduced to distinct days
    per (customer, channel), unioned, and a running minimum over the days in
    descending order gives each lead day its next contact day. The window is
    partitioned by (customer, channel) at day grain, so even a customer with a
    third of all rows contributes at most one row per distinct day.
    """
    ch = profile.channel_column
    contact_days = interactions.where(
        F.col("customer_id").isNotNull() & F.col("interaction_date").isNotNull()
    ).select("customer_id", F.col(ch).alias("channel_key"),
             F.col("interaction_date").alias("day")).distinct()
    lead_days = leads.where(
        F.col("customer_id").isNotNull() & F.col("created_at").isNotNull()
    ).groupBy("customer_id", F.col("created_at").alias("day")).agg(
        F.count(F.lit(1)).alias("n_leads"))
    cust_channels = contact_days.select("customer_id", "channel_key").distinct()
    lead_rows = lead_days.join(cust_channels, "customer_id", "inner").select(
        "customer_id", "channel_key", "day", "n_leads", F.lit(0).alias("kind"))
    contact_rows = contact_days.select(
        "customer_id", "channel_key", "day", F.lit(0).cast("bigint").alias("n_leads"),
        F.lit(1).alias("kind"))
    w = (Window.partitionBy("customer_id", "channel_key")
         .orderBy(F.col("day").desc(), F.col("kind").desc())
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    marked = lead_rows.unionByName(contact_rows).withColumn(
        "next_contact", F.min(F.when(F.col("kind") == 1, F.col("day"))).over(w))
    answered = marked.where((F.col("kind") == 0) & F.col("next_contact").isNotNull()).withColumn(
        "days", F.datediff(F.col("next_contact"), F.col("day")))
    out = answered.groupBy("channel_key").agg(
        F.sum("n_leads").alias("leads_answered"),
        F.sum(F.col("days") * F.col("n_leads")).alias("__days"))
    return out.select(F.col("channel_key").alias(ch), "leads_answered",
                      F.round(F.col("__days") / F.col("leads_answered"), 4).alias("avg_response_days"))


def daily_trend(daily: DataFrame) -> DataFrame:
    """MT-21 (documented): change of revenue and deal count against the
    previous day present in the daily summary.

    The window is unpartitioned by design but runs on the *daily* table (one
    row per day: a few thousand rows for decades of data), never on raw deals.
    """
    w = Window.orderBy(F.col("deal_date").asc())
    d = daily.where(F.col("deal_date").isNotNull()).select("deal_date", "total_deals", "revenue_won")
    return d.select(
        "deal_date", "total_deals", "revenue_won",
        (F.col("revenue_won") - F.lag("revenue_won").over(w)).alias("revenue_change"),
        (F.col("total_deals") - F.lag("total_deals").over(w)).alias("deals_change"),
    )
