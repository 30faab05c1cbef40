"""Declared schemas of the raw (bronze) and clean (silver) layers."""

from __future__ import annotations

from pyspark.sql.types import (
    DoubleType,
    IntegerType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)

# Raw column lists of the four entities, in file order.
RAW_COLUMNS: dict[str, tuple[str, ...]] = {
    "leads": (
        "lead_id", "customer_id", "lead_name", "email", "phone", "company",
        "deal_value", "status", "created_at", "updated_at", "source",
    ),
    "customers": (
        "customer_id", "customer_name", "industry", "country", "city",
        "employee_count", "annual_revenue", "account_manager", "created_at",
    ),
    "interactions": (
        "interaction_id", "customer_id", "channel", "interaction_date",
        "interaction_time_minutes", "outcome", "notes",
    ),
    "products": (
        "product_id", "product_name", "category", "base_price", "currency",
        "launch_date",
    ),
}

# Business key of each entity (dedupe key).
KEYS: dict[str, str] = {
    "leads": "lead_id",
    "customers": "customer_id",
    "interactions": "interaction_id",
    "products": "product_id",
}


def raw_schema(entity: str) -> StructType:
    """All-string schema of a raw entity, so header drift is detected."""
    return StructType([StructField(c, StringType(), True) for c in RAW_COLUMNS[entity]])


_S, _D, _I, _T = StringType(), DoubleType(), IntegerType(), TimestampNTZType()

# Clean-layer types. Dates are stored as midnight TIMESTAMP_NTZ so the value
# does not depend on the session time zone.
CLEAN_TYPES: dict[str, dict[str, object]] = {
    "leads": {
        "lead_id": _S, "customer_id": _S, "lead_name": _S, "email": _S, "phone": _S,
        "company": _S, "deal_value": _D, "status": _S, "created_at": _T,
        "updated_at": _T, "source": _S, "is_contactable": _I,
    },
    "customers": {
        "customer_id": _S, "customer_name": _S, "industry": _S, "country": _S,
        "city": _S, "employee_count": _I, "annual_revenue": _D,
        "account_manager": _S, "created_at": _T,
    },
    "interactions": {
        "interaction_id": _S, "customer_id": _S, "channel": _S,
        "interaction_date": _T, "interaction_time_minutes": _I, "outcome": _S,
        "notes": _S, "channel_standardized": _S,
    },
    "products": {
        "product_id": _S, "product_name": _S, "category": _S, "base_price": _D,
        "currency": _S, "launch_date": _T,
    },
}


# Numeric columns of a feature table written as CSV; others (and the counts per
# channel and outcome, ``num_*``) follow from their names.
FEATURE_NUMBERS = {
    "employee_count", "annual_revenue", "total_interactions", "avg_interaction_duration", "total_revenue",
    "total_deals", "avg_deal_value", "engagement_score", "lead_score", "conversion_rate", "win_rate",
    "probability_to_convert", "interaction_frequency", "days_since_last_interaction", "open_deal_value",
}


def features_schema(columns: list[str]) -> StructType:
    """Declared types of a features CSV with this header: doubles for numbers, text for the rest."""
    return StructType([StructField(c, _D if c in FEATURE_NUMBERS or c.startswith("num_") else _S, True)
                       for c in columns])


def clean_schema(entity: str) -> StructType:
    return StructType([StructField(n, t, True) for n, t in CLEAN_TYPES[entity].items()])
