"""Deduplication (DD-1..3)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _as_list(keys: str | Sequence[str]) -> list[str]:
    return [keys] if isinstance(keys, str) else list(keys)


def default_order(df: DataFrame, keys: Sequence[str]) -> list[Column]:
    """Every non-key column ascending, NULLs last: a total, input-independent order."""
    return [F.col(c).asc_nulls_last() for c in df.columns if c not in keys]


def keep_first(df: DataFrame, keys: str | Sequence[str],
               order_by: Sequence[Column] | None = None) -> DataFrame:
    """DD-1 / DD-3: one row per key, the first in a declared order.

    Rows with a NULL key form one group, as ``dropDuplicates`` treats them.
    ``row_number() == 1`` lets Catalyst insert a WindowGroupLimit, which also
    runs *before* the shuffle, so a key that holds a third of all rows is cut
    to one row per map task before it reaches its reducer.
    """
    keys = _as_list(keys)
    order = list(order_by) if order_by is not None else default_order(df, keys)
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__dedupe_rank", F.row_number().over(w)).where(
        F.col("__dedupe_rank") == 1).drop("__dedupe_rank")


def duplicate_counts(raw: DataFrame, keys: str | Sequence[str]) -> DataFrame:
    """DD-2: one row ``raw_rows, clean_rows, duplicates_removed`` in one aggregate.

    ``clean_rows`` counts distinct keys plus one group for NULL keys (the
    dedupe keeps one NULL-key row). The distinct count is planned as a map-side
    pre-aggregation on the key, so no key is gathered whole in one task.
    """
    keys = _as_list(keys)
    if len(keys) == 1:
        k = F.col(keys[0])
        null_group = F.coalesce(F.max(k.isNull().cast("int")), F.lit(0)).cast("bigint")
        clean = F.count_distinct(k) + null_group
    else:
        # a struct is never NULL, so NULL-containing key combinations count too
        clean = F.count_distinct(F.struct(*[F.col(k) for k in keys]))
    return raw.agg(F.count(F.lit(1)).alias("raw_rows"), clean.alias("clean_rows")).withColumn(
        "duplicates_removed", F.col("raw_rows") - F.col("clean_rows"))
