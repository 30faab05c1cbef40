"""AG-5 / AG-12, opt-in and approximate: sketches that are stored once and merged without the rows.

Distinct counts use HyperLogLog sketches, quantiles KLL sketches. Both merge
in any order, so daily sketches roll up to months, channels or the whole table.
The exact operators (``aggregate``, ``profile``) stay the default.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: log2 of the registers of a distinct-count sketch: a standard error of 1.04 / sqrt(2**12), 1.6 %.
LG_REGISTERS = 12
#: Three standard errors.
DISTINCT_ERROR = 3 * 1.04 / 2 ** (LG_REGISTERS / 2)

#: KLL parameter: ranks lie within 0.4 % at 99 % confidence; ``RANK_ERROR`` is asserted in tests.
KLL_K = 800
RANK_ERROR = 0.01


def distinct_sketches(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """AG-5: (keys, rows, sketch), one mergeable sketch of the distinct ``value`` per group."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows"), F.hll_sketch_agg(value, F.lit(LG_REGISTERS)).alias("sketch"))


def rolled_up_distinct(sketches: DataFrame, keys: Sequence[str], alias: str) -> DataFrame:
    """AG-5: (keys, rows, ``alias``): stored sketches merged to coarser groups, without raw rows."""
    return sketches.groupBy(*keys).agg(F.sum("rows").alias("rows"), F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias(alias))


def _number(column: str) -> Column:
    x = F.col(column).cast("double")
    return F.when(~F.isnan(x), x)  # NULL and NaN have no rank


def quantile_sketches(df: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """AG-12: (keys, one sketch per column), in one pass over ``df``."""
    return df.groupBy(*keys).agg(*[F.kll_sketch_agg_double(_number(c), F.lit(KLL_K)).alias(c) for c in columns])


def rolled_up_quantiles(sketches: DataFrame, keys: Sequence[str], columns: Sequence[str], quantiles: Sequence[float]) -> DataFrame:
    """AG-12: (keys, column_name, quantile, value) from stored sketches."""
    merged = sketches.groupBy(*keys).agg(*[F.kll_merge_agg_double(c, F.lit(KLL_K)).alias(c) for c in columns])
    cells = [F.struct(F.lit(c).alias("column_name"), F.lit(q).alias("quantile"), F.when(
        F.kll_sketch_get_n_double(c) > 0, F.kll_sketch_get_quantile_double(c, F.lit(q))).alias("value")) for c in columns for q in quantiles]
    return merged.select(*keys, F.explode(F.array(*cells)).alias("s")).select(*keys, "s.*")


def rank_errors(df: DataFrame, found: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column_name, quantile, value, n, rank_error): how far each found quantile
    lies from its rank in ``df``, as a share of the rows; equal values share a
    range of ranks. One pass of conditional counts."""
    spots = found.agg(F.collect_list(F.struct("column_name", "quantile", "value"))).first()[0]  # one per column and quantile
    counts = []
    for k, r in enumerate(spots):
        x = _number(r["column_name"])
        counts += [F.count_if(x < F.lit(r["value"])).alias(f"under_{k}"), F.count_if(x <= F.lit(r["value"])).alias(f"upto_{k}"),
                   F.count(x).alias(f"n_{k}")]
    wide = df.agg(*counts)
    rows = []
    for k, r in enumerate(spots):
        sought = F.lit(r["quantile"]) * F.col(f"n_{k}")
        off = F.greatest(F.col(f"under_{k}") - sought, sought - F.col(f"upto_{k}"), F.lit(0.0)) / F.col(f"n_{k}")
        rows.append(F.struct(F.lit(r["column_name"]).alias("column_name"), F.lit(r["quantile"]).alias("quantile"),
                             F.lit(r["value"]).alias("value"), F.col(f"n_{k}").alias("n"), off.alias("rank_error")))
    return wide.select(F.explode(F.array(*rows)).alias("s")).select("s.*")
