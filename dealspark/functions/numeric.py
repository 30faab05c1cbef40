"""Numeric helpers shared by the metric operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

# Money is summed as DECIMAL(28,4): exact and independent of the order in
# which partitions are combined (a double sum is not, so at cluster scale it
# would change in the last bits from run to run).
MONEY_DECIMAL = DecimalType(28, 4)


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def exact_sum(c: str | Column) -> Column:
    """Order-independent sum of a double money column, returned as double.

    A value that the decimal does not hold exactly (more than four decimals,
    beyond its range, NaN or ±Infinity) makes its group fall back to the
    plain double sum, so no value is cut or skipped.
    """
    c = _col(c).cast("double")
    as_dec = c.try_cast(MONEY_DECIMAL)
    unfit = c.isNotNull() & ~F.coalesce(as_dec.cast("double") == c, F.lit(False))
    return F.when(F.count_if(unfit) > 0, F.sum(c)).otherwise(F.sum(as_dec).cast("double"))


def exact_avg(c: str | Column) -> Column:
    """Mean of a double money column (NULLs skipped) = exact sum / count."""
    c = _col(c)
    return F.try_divide(exact_sum(c), F.count(c))


def smoothed_ratio(num: Column, den: Column, eps: float = 0.001) -> Column:
    """``num / (den + eps)`` in double arithmetic (the reference's 0.001 guard)."""
    return num / (den + F.lit(float(eps)))
