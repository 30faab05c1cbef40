"""Raw → clean operators (CL-5, CL-7, CL-10..16, CL-18, CL-19, FL-4).

Each entity is cleaned in a single projection (Catalyst collapses it into one
``Project`` inside whole-stage codegen) followed by the keyed dedupe.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dealspark.functions.cleaning import (
    contactable,
    mask_email,
    mask_phone,
    norm_lower,
    norm_trim,
    parse_date,
    parse_double,
    parse_int,
    standardize_channel,
    strip_special,
)
from dealspark.operators.dedupe import keep_first
from dealspark.schemas import KEYS, RAW_COLUMNS, clean_schema


def _key(c: str) -> Column:
    return F.col(c).cast("string")


def type_leads(raw: DataFrame) -> DataFrame:
    """Typed projection of raw leads (no dedupe); one ``Project``."""
    email, phone = norm_lower("email"), norm_trim("phone")
    return raw.select(
        _key("lead_id").alias("lead_id"),
        _key("customer_id").alias("customer_id"),
        norm_trim("lead_name").alias("lead_name"),
        email.alias("email"),
        phone.alias("phone"),
        norm_trim("company").alias("company"),
        F.coalesce(parse_double("deal_value"), F.lit(0.0)).alias("deal_value"),
        norm_lower("status").alias("status"),
        parse_date("created_at").alias("created_at"),
        parse_date("updated_at").alias("updated_at"),
        norm_trim("source").alias("source"),
        contactable(email, phone).alias("is_contactable"),
    )


def clean_leads(raw: DataFrame, order_by: Sequence[Column] | None = None) -> DataFrame:
    """CL-12: typed, trimmed leads with ``is_contactable``; one row per lead_id."""
    return keep_first(type_leads(raw), KEYS["leads"], order_by)


def type_customers(raw: DataFrame) -> DataFrame:
    """Typed projection of raw customers (no dedupe); one ``Project``."""
    return raw.select(
        _key("customer_id").alias("customer_id"),
        norm_trim("customer_name").alias("customer_name"),
        norm_trim("industry").alias("industry"),
        norm_trim("country").alias("country"),
        norm_trim("city").alias("city"),
        F.coalesce(parse_int("employee_count"), F.lit(0)).alias("employee_count"),
        F.coalesce(parse_double("annual_revenue"), F.lit(0.0)).alias("annual_revenue"),
        norm_trim("account_manager").alias("account_manager"),
        parse_date("created_at").alias("created_at"),
    )


def clean_customers(raw: DataFrame, order_by: Sequence[Column] | None = None) -> DataFrame:
    """CL-13: typed, trimmed customers; one row per customer_id."""
    return keep_first(type_customers(raw), KEYS["customers"], order_by)


def type_interactions(raw: DataFrame) -> DataFrame:
    """Typed projection of raw interactions (no dedupe); one ``Project``."""
    channel = norm_lower("channel")
    return raw.select(
        _key("interaction_id").alias("interaction_id"),
        _key("customer_id").alias("customer_id"),
        channel.alias("channel"),
        parse_date("interaction_date").alias("interaction_date"),
        F.coalesce(parse_int("interaction_time_minutes"), F.lit(0)).alias("interaction_time_minutes"),
        norm_lower("outcome").alias("outcome"),
        F.coalesce(norm_trim("notes"), F.lit("")).alias("notes"),
        standardize_channel(channel).alias("channel_standardized"),
    )


def clean_interactions(raw: DataFrame, order_by: Sequence[Column] | None = None) -> DataFrame:
    """CL-14: typed interactions with ``channel_standardized``; one row per id."""
    return keep_first(type_interactions(raw), KEYS["interactions"], order_by)


def type_products(raw: DataFrame) -> DataFrame:
    """Typed projection of raw products (no dedupe); one ``Project``."""
    return raw.select(
        _key("product_id").alias("product_id"),
        norm_trim("product_name").alias("product_name"),
        norm_trim("category").alias("category"),
        F.coalesce(parse_double("base_price"), F.lit(0.0)).alias("base_price"),
        norm_trim("currency").alias("currency"),
        parse_date("launch_date").alias("launch_date"),
    )


def clean_products(raw: DataFrame, order_by: Sequence[Column] | None = None) -> DataFrame:
    """CL-15: typed products; one row per product_id."""
    return keep_first(type_products(raw), KEYS["products"], order_by)


def declared_casts(entity: str) -> dict[str, tuple[str, Column]]:
    """The declared type and the parser of each raw column that is not text (DQ-2)."""
    parsers = {"double": parse_double, "int": parse_int, "timestamp_ntz": parse_date}
    types = {f.name: f.dataType.simpleString() for f in clean_schema(entity).fields}
    return {c: (types[c], parsers[types[c]](c)) for c in RAW_COLUMNS[entity] if types[c] in parsers}


TYPERS = {
    "leads": type_leads,
    "customers": type_customers,
    "interactions": type_interactions,
    "products": type_products,
}

CLEANERS = {
    "leads": clean_leads,
    "customers": clean_customers,
    "interactions": clean_interactions,
    "products": clean_products,
}


def with_audit(df: DataFrame, run_ts: Column | None = None) -> DataFrame:
    """CL-10: append ``processed_at``; pass a literal for reproducible runs."""
    return df.withColumn("processed_at", run_ts if run_ts is not None else F.current_timestamp())


def normalize_text(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """CL-16 (documented): trim, lower and strip special characters in place."""
    return df.withColumns({c: strip_special(c) for c in columns})


def fill_defaults(df: DataFrame, defaults: Mapping[str, object]) -> DataFrame:
    """CL-18 (documented): per-column NULL defaults, e.g. ``{"status": "unknown"}``."""
    present = {k: v for k, v in defaults.items() if k in df.columns}
    return df.fillna(present) if present else df


def drop_missing_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """FL-4 (documented): drop rows whose critical key is NULL."""
    return df.dropna(subset=list(keys))


def mask_contacts(df: DataFrame, email: str = "email", phone: str = "phone") -> DataFrame:
    """CL-19 (documented, optional): hash e-mail local parts, keep 4 phone digits."""
    return df.withColumns({email: mask_email(email), phone: mask_phone(phone)})
