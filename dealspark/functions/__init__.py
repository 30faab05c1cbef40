"""Column expressions (no actions, no DataFrames): cleaning, metrics, scoring."""

from dealspark.functions.cleaning import (  # noqa: F401
    contactable,
    mask_email,
    mask_phone,
    norm_lower,
    norm_trim,
    parse_date,
    parse_day,
    parse_double,
    parse_int,
    standardize_channel,
    strip_special,
)
from dealspark.functions.numeric import exact_avg, exact_sum, smoothed_ratio  # noqa: F401
