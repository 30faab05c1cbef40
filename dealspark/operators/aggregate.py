"""Per-customer, per-day and per-channel aggregates (AG-1..6, MT-1..9, TK-1).

All of them are single ``groupBy().agg()`` passes: Spark plans a partial
(map-side) hash aggregate before the shuffle, so a customer, day or channel
holding a third of the rows is reduced to one row per map task first.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dealspark.functions.numeric import exact_avg, exact_sum, smoothed_ratio
from dealspark.functions.scoring import (
    conversion_rate,
    days_since,
    engagement_score,
    frequency_per_day,
    preferred_channel,
    win_rate,
)
from dealspark.plans.profiles import NOTEBOOK, ScoringProfile

# Status and outcome domains of the clean layer.
WON, LOST, OPEN = "closed_won", "closed_lost", "open"
POSITIVE, NEGATIVE, NEUTRAL = "positive", "negative", "neutral"


def _is(col: str, value: str):
    return F.col(col) == F.lit(value)


def interaction_metrics(interactions: DataFrame, as_of: _dt.date,
                        profile: ScoringProfile = NOTEBOOK) -> DataFrame:
    """AG-1 + MT-1..4: one row per customer_id (a NULL customer is one group)."""
    ch = profile.channel_column
    agg = interactions.groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("total_interactions"),
        F.count_if(_is(ch, "call")).alias("num_calls"),
        F.count_if(_is(ch, "whatsapp")).alias("num_whatsapp"),
        F.count_if(_is(ch, "email")).alias("num_emails"),
        F.count_if(_is("outcome", POSITIVE)).alias("num_positive_outcomes"),
        F.count_if(_is("outcome", NEGATIVE)).alias("num_negative_outcomes"),
        F.count_if(_is("outcome", NEUTRAL)).alias("num_neutral_outcomes"),
        F.avg("interaction_time_minutes").alias("avg_interaction_duration_minutes"),
        F.max("interaction_date").alias("last_interaction_date"),
        F.min("interaction_date").alias("first_interaction_date"),
    )
    return agg.withColumns({
        "days_since_last_interaction": days_since("last_interaction_date", as_of),
        "interaction_frequency_per_day": frequency_per_day(
            "total_interactions", "first_interaction_date", as_of),
        "preferred_channel": preferred_channel("num_calls", "num_whatsapp", "num_emails"),
        "engagement_score": engagement_score(
            "num_positive_outcomes", "total_interactions", "num_negative_outcomes", profile),
    })


def deal_metrics(leads: DataFrame, profile: ScoringProfile = NOTEBOOK) -> DataFrame:
    """AG-2 + MT-5..7: one row per customer_id.

    ``total_revenue`` counts deals whose status is in ``profile.revenue_statuses``
    (closed_won by default; every deal when None).
    """
    won = _is("status", WON)
    statuses = profile.revenue_statuses
    rev_cond = F.lit(True) if statuses is None else F.col("status").isin(*statuses)
    agg = leads.groupBy("customer_id").agg(
        exact_sum(F.when(rev_cond, F.col("deal_value")).otherwise(F.lit(0.0))).alias("total_revenue"),
        F.count_if(won).alias("num_closed_won"),
        F.count_if(_is("status", LOST)).alias("num_closed_lost"),
        F.count_if(_is("status", OPEN)).alias("num_open_deals"),
        exact_sum("deal_value").alias("total_deal_value"),
        exact_avg(F.when(won, F.col("deal_value"))).alias("avg_won_deal_value"),
        F.max("deal_value").alias("max_deal_value"),
        F.count(F.lit(1)).alias("total_deals"),
    )
    avg_deal = smoothed_ratio(F.col("total_deal_value"), F.col("total_deals"), profile.smoothing)
    return agg.withColumns({
        "conversion_rate": conversion_rate("num_closed_won", "num_closed_lost", profile),
        "win_rate": win_rate("num_closed_won", "total_deals", profile),
        "avg_deal_value": F.round(avg_deal, 2) if profile.rounded else avg_deal,
    })


def sales_summary(leads: DataFrame, profile: ScoringProfile = NOTEBOOK) -> DataFrame:
    """AG-3 + MT-8 + TK-1: daily deal metrics by ``created_at``, newest first.

    An unparsable creation date is one NULL day. ``unique_customers`` is an
    exact distinct count; Spark first aggregates on (day, customer), so a hot
    day is spread over customers before the final per-day merge.
    """
    won = _is("status", WON)
    daily = leads.groupBy(F.col("created_at").alias("deal_date")).agg(
        F.count(F.lit(1)).alias("total_deals"),
        F.count_if(won).alias("deals_won"),
        F.count_if(_is("status", LOST)).alias("deals_lost"),
        F.count_if(_is("status", OPEN)).alias("deals_open"),
        exact_sum(F.when(won, F.col("deal_value")).otherwise(F.lit(0.0))).alias("revenue_won"),
        exact_sum("deal_value").alias("total_deal_value"),
        F.count_distinct("customer_id").alias("unique_customers"),
    )
    return daily.withColumn(
        "win_rate_daily", conversion_rate("deals_won", "deals_lost", profile)
    ).orderBy(F.col("deal_date").desc())


def channel_performance(interactions: DataFrame, profile: ScoringProfile = NOTEBOOK) -> DataFrame:
    """AG-4 + MT-9 + TK-1: per standardised channel, busiest first."""
    ch = profile.channel_column
    per = interactions.groupBy(ch).agg(
        F.count(F.lit(1)).alias("total_interactions"),
        F.count_if(_is("outcome", POSITIVE)).alias("positive_outcomes"),
        F.count_if(_is("outcome", NEGATIVE)).alias("negative_outcomes"),
        F.count_if(_is("outcome", NEUTRAL)).alias("neutral_outcomes"),
        F.avg("interaction_time_minutes").alias("avg_duration_minutes"),
        F.count_distinct("customer_id").alias("unique_customers"),
    )
    pos_rate = smoothed_ratio(F.col("positive_outcomes"), F.col("total_interactions"), profile.smoothing)
    per_cust = smoothed_ratio(F.col("total_interactions"), F.col("unique_customers"), profile.smoothing)
    return per.withColumns({
        "positive_rate": F.round(pos_rate, 4),
        "interactions_per_customer": F.round(per_cust, 2),
    }).orderBy(F.col("total_interactions").desc(), F.col(ch).asc_nulls_last())
