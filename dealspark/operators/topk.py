"""Sort, limit and top-k (TK-1..7). A limit here is the feature itself.

``orderBy(...).limit(k)`` plans as TakeOrderedAndProject: every task keeps
its own k best rows and only k × tasks rows reach the final merge, so no
partition or group is gathered whole. Every ordering ends with a unique key,
so ties resolve the same way on every run.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# The columns of the curated top-customers table.
TOP_CUSTOMER_COLUMNS = (
    "customer_id", "customer_name", "industry", "annual_revenue", "total_revenue",
    "num_closed_won", "total_interactions", "engagement_score", "lead_score",
    "lead_quality", "account_manager",
)


def top_customers(features: DataFrame, n: int = 50) -> DataFrame:
    """TK-2: the n customers with the highest total revenue, 11 columns."""
    return features.select(*TOP_CUSTOMER_COLUMNS).orderBy(
        F.col("total_revenue").desc(), F.col("customer_id").asc()).limit(n)


def top_by_revenue_ascending(features: DataFrame, n: int = 10) -> DataFrame:
    """TK-3: the n largest revenues, listed ascending (chart order)."""
    top = features.select("customer_id", "customer_name", "total_revenue").orderBy(
        F.col("total_revenue").desc(), F.col("customer_id").asc()).limit(n)
    return top.orderBy(F.col("total_revenue").asc(), F.col("customer_id").desc())


def top_by_lead_score(features: DataFrame, n: int = 10) -> DataFrame:
    """TK-4: the n best lead scores with a 1-based rank (rank taken after the limit)."""
    top = features.select("customer_id", "customer_name", "lead_score", "total_revenue",
                          "lead_quality").orderBy(
        F.col("lead_score").desc(), F.col("customer_id").asc()).limit(n)
    w = Window.orderBy(F.col("lead_score").desc(), F.col("customer_id").asc())
    return top.withColumn("rank", F.row_number().over(w))


def hot_leads(spark: SparkSession, features: DataFrame, n: int = 10) -> DataFrame:
    """FL-5 + TK-7 (documented SQL): hot customers by score. The table is an
    argument of the statement, so concurrent calls share no view name."""
    return spark.sql(f"""
        SELECT customer_id, customer_name, lead_score, preferred_channel,
               total_revenue, engagement_score
        FROM {{features}}
        WHERE lead_quality = 'hot'
        ORDER BY lead_score DESC, customer_id ASC
        LIMIT {int(n)}
    """, features=features)
