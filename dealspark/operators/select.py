"""Exact selection by rank without gathering a group: bucket counts narrow the
values to a thin band, and only the band is ranked."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# A pass splits the current interval of each group into so many buckets. Map
# tasks send one count per bucket and group at most, whatever their rows.
BUCKETS = 65_536


def narrowed(df: DataFrame, group: str, place: str, start: Column, end: Column,
             limits: DataFrame | None, low: Column, high: Column) -> DataFrame:
    """One row per group: n, low and high (the ranks sought), below (rows under
    the band) and the band [lo, hi] of ``place`` that holds both ranks.

    ``limits`` is this function's result for a wider band (None: all rows). It
    is broadcast: one row per group, where groups are columns or classes.
    """
    rows = df
    if limits is not None:
        rows = df.join(F.broadcast(limits), group).where((F.col(place) >= F.col("lo")) & (F.col(place) <= F.col("hi")))
        start, end = F.col("lo"), F.col("hi")
    share = F.try_divide(F.col(place) - start, end - start)
    bucket = F.coalesce(F.least(F.floor(share * F.lit(float(BUCKETS))), F.lit(BUCKETS - 1)), F.lit(0))
    carried = ["n", "low", "high", "below"] if limits is not None else []
    counts = rows.groupBy(group, *carried, bucket.alias("bucket")).agg(
        F.count(F.lit(1)).alias("c"), F.min(place).alias("from"), F.max(place).alias("to"))
    # at most BUCKETS rows per group from here on
    upto = Window.partitionBy(group).orderBy("bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    if limits is None:
        counts = counts.withColumn("n", F.sum("c").over(Window.partitionBy(group)))
        counts = counts.withColumn("low", low).withColumn("high", high).withColumn("below", F.lit(0).cast("bigint"))
    counts = counts.withColumn("upto", F.sum("c").over(upto) + F.col("below"))
    before = F.col("upto") - F.col("c")
    inside = (F.col("upto") >= F.col("low")) & (before < F.col("high"))
    return counts.where(inside).groupBy(group, "n", "low", "high").agg(
        F.min(before).alias("below"), F.min("from").alias("lo"), F.max("to").alias("hi"))


def ranked_band(df: DataFrame, group: str, place: str, value: str, start: float, end: float,
                low: Column, high: Column) -> DataFrame:
    """(group, value, c, n, low, high, below): the distinct values of each group
    around the ranks ``low`` and ``high`` (1-based columns over n), with their
    row counts, and the number of rows before them.

    Two passes of bucket counts leave a band of about n / 2**32 of the rows
    where ``place`` (monotone in ``value``, within [start, end]) is even.
    """
    wide = narrowed(df, group, place, F.lit(start), F.lit(end), None, low, high)
    thin = narrowed(df, group, place, F.lit(start), F.lit(end), wide, low, high)
    return df.join(F.broadcast(thin), group).where((F.col(place) >= F.col("lo")) & (F.col(place) <= F.col("hi"))).groupBy(
        group, value, "n", "low", "high", "below").agg(F.count(F.lit(1)).alias("c"))
