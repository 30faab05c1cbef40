"""Joins that spread a hot key over tasks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Tasks over which the rows of one key spread; the other side has one row per
# key and is repeated as often.
SALTS = 16


def salted_join(rows: DataFrame, one_per_key: DataFrame, key: str, how: str, spread_by: str,
                salts: int = SALTS) -> DataFrame:
    """``rows`` joined to ``one_per_key`` on ``key``, both also on a salt (a hash
    of ``spread_by`` on the rows' side). It does not depend on sizes: Spark's own
    skew splitting does not apply where the other side comes from an aggregate."""
    salt = F.pmod(F.xxhash64(spread_by), F.lit(salts)).cast("int")
    copies = F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))
    return rows.withColumn("__salt", salt).join(
        one_per_key.withColumn("__salt", copies), [key, "__salt"], how).drop("__salt")
