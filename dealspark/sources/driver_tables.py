"""Adapters: the four raw CRM entities derived from the benchmark tables.

The benchmark has no CRM tables, so the raw shapes are built from
``customer ⋈ nation ⋈ region`` (customers), ``orders`` (leads), ``events``
(interactions) and ``part`` (products). Every raw column is a string, and a
deterministic share of values is made dirty (padding, mixed case, bad
numbers and dates, NULL contacts, duplicate lead keys) so that the cleaning
rules are exercised. The SQL oracle builds the same rows with the same rules.
Everything is row-local projection plus one union, so the adapters scale
with the tables and add no shuffle of their own.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


# Reporting date and revenue unit used for the benchmark data
# (events end on 2024-01-30; with the library default unit 100,000 nearly
# every benchmark customer would be "hot").
AS_OF = _dt.date(2024, 2, 1)
REVENUE_UNIT = 1_000_000.0

# Event type → raw channel spelling; order status → raw status.
CHANNEL_OF_EVENT = (
    ("click", "Phone"),
    ("signup", "call"),
    ("view", "E-Mail"),
    ("purchase", "WhatsApp Message"),
    ("error", "sms"),
)
STATUS_OF_ORDER = (("F", " Closed_Won "), ("P", "closed_lost"), ("O", "OPEN"))
# Raw channel values after trim + lower, for explicit pivots.
RAW_CHANNELS = ("call", "e-mail", "phone", "sms", "whatsapp message")


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")


def _s(c: Column) -> Column:
    return c.cast("string")


def _case(c: Column, pairs) -> Column:
    expr = None
    for k, v in pairs:
        expr = F.when(c == F.lit(k), F.lit(v)) if expr is None else expr.when(c == F.lit(k), F.lit(v))
    return expr


def raw_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    c, n, r = load(spark, sf_dir, "customer"), load(spark, sf_dir, "nation"), load(spark, sf_dir, "region")
    k = F.col("c_custkey")
    emp = _s(F.lit(45) + (k * F.lit(37)) % F.lit(4956))
    # nation / region have a fixed size (25 and 5 rows by definition), so they
    # are broadcast: customers never shuffle on a nation key, however skewed.
    j = (c.join(F.broadcast(n), c.c_nationkey == n.n_nationkey, "left")
         .join(F.broadcast(r), n.n_regionkey == r.r_regionkey, "left"))
    return j.select(
        _s(k).alias("customer_id"),
        F.when(k % 7 == 0, F.concat(F.lit(" "), F.col("c_name"), F.lit(" "))).otherwise(
            F.col("c_name")).alias("customer_name"),
        F.col("c_mktsegment").alias("industry"),
        F.col("n_name").alias("country"),
        F.col("r_name").alias("city"),
        F.when(k % 50 == 0, F.lit("12x")).when(k % 50 == 25, F.concat(emp, F.lit(".7"))).otherwise(
            emp).alias("employee_count"),
        F.when(k % 40 == 0, F.lit("n/a")).otherwise(_s(F.col("c_acctbal"))).alias("annual_revenue"),
        F.when(k % 13 == 0, F.lit(None).cast("string")).otherwise(
            F.concat(F.lit("AM"), _s(k % 20))).alias("account_manager"),
        F.date_format(F.date_add(F.lit(_dt.date(2020, 1, 1)), (k % 1000).cast("int")),
                      "yyyy-MM-dd").alias("created_at"),
    )


def raw_leads(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = load(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority")
    # duplicate keys with another payload: every 20th order once more, +1 value
    copies = F.when(F.col("o_orderkey") % 20 == 0, F.array(F.lit(0.0), F.lit(1.0))).otherwise(F.array(F.lit(0.0)))
    o = o.withColumn("__more", F.explode(copies))
    o = o.withColumn("o_totalprice", F.col("o_totalprice") + F.col("__more")).drop("__more")
    k = F.col("o_orderkey")
    day = F.date_format(F.col("o_orderdate"), "yyyy-MM-dd")
    return o.select(
        _s(k).alias("lead_id"),
        _s(F.col("o_custkey")).alias("customer_id"),
        F.concat(F.lit("Lead "), _s(k)).alias("lead_name"),
        F.when(k % 10 == 0, F.lit(None).cast("string")).otherwise(
            F.concat(F.lit(" Contact"), _s(k), F.lit("@Example.COM"))).alias("email"),
        F.when(k % 15 == 0, F.lit(None).cast("string")).otherwise(
            F.concat(F.lit("555-"), F.lpad(_s(k % 10000), 4, "0"))).alias("phone"),
        F.concat(F.lit("Company "), _s(F.col("o_custkey"))).alias("company"),
        F.when(k % 50 == 0, F.lit("n/a")).otherwise(_s(F.col("o_totalprice"))).alias("deal_value"),
        _case(F.col("o_orderstatus"), STATUS_OF_ORDER).alias("status"),
        F.when(k % 97 == 0, F.lit("2024/13/45")).otherwise(day).alias("created_at"),
        day.alias("updated_at"),
        F.col("o_orderpriority").alias("source"),
    )


def raw_interactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = load(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value")
    k = F.col("event_id")
    ch = _case(F.col("event_type"), CHANNEL_OF_EVENT)
    minutes = _s(F.floor(F.col("value")))
    outcome = (F.when(F.col("value") >= 50, F.lit("positive"))
               .when(F.col("value") < 10, F.lit("negative")).otherwise(F.lit("neutral")))
    return e.select(
        _s(k).alias("interaction_id"),
        _s(F.col("user_id")).alias("customer_id"),
        F.when(k % 9 == 0, F.concat(F.lit(" "), ch, F.lit(" "))).otherwise(ch).alias("channel"),
        F.date_format(F.col("ts"), "yyyy-MM-dd").alias("interaction_date"),
        F.when(k % 50 == 0, F.lit("12x")).when(k % 11 == 0, F.concat(minutes, F.lit(".5"))).otherwise(
            minutes).alias("interaction_time_minutes"),
        F.when(k % 7 == 0, F.initcap(outcome)).otherwise(outcome).alias("outcome"),
        F.when(k % 4 == 0, F.lit(None).cast("string")).otherwise(
            F.concat(F.lit(" note "), F.col("event_type"), F.lit(" "))).alias("notes"),
    )


def raw_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = load(spark, sf_dir, "part")
    month = F.lpad(_s(F.col("p_size") % 12 + F.lit(1)), 2, "0")
    return p.select(
        _s(F.col("p_partkey")).alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.col("p_type").alias("category"),
        _s(F.col("p_retailprice")).alias("base_price"),
        F.lit("USD").alias("currency"),
        F.concat(F.lit("2023-"), month, F.lit("-15")).alias("launch_date"),
    )


RAW = {
    "customers": raw_customers,
    "leads": raw_leads,
    "interactions": raw_interactions,
    "products": raw_products,
}
