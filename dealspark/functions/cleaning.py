"""Scalar cleaning expressions (raw string → typed value).

All parsers are ``try_*`` based: Spark 4 runs with ANSI mode on, where a plain
``cast`` of malformed text raises; the cleaning contract is "bad value → NULL".
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Channel synonyms of the standardisation rule
# (target value first, then the accepted spellings after trim + lower).
CHANNEL_SYNONYMS: tuple[tuple[str, tuple[str, ...]], ...] = (
    ("call", ("call", "phone")),
    ("whatsapp", ("whatsapp", "whatsapp message")),
    ("email", ("email", "e-mail")),
)
# Fixed value: the only accepted date layout of the raw files.
DATE_FORMAT = "yyyy-MM-dd"


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def norm_lower(c: str | Column) -> Column:
    """CL-1: lower-case then strip spaces (tabs are kept, as Spark ``trim`` does)."""
    return F.trim(F.lower(_col(c)))


def norm_trim(c: str | Column) -> Column:
    """CL-2: strip leading/trailing spaces."""
    return F.trim(_col(c))


def parse_double(c: str | Column) -> Column:
    """CL-3: text → double; malformed text → NULL, the text ``NaN`` → NaN."""
    return _col(c).try_cast("double")


def parse_int(c: str | Column) -> Column:
    """CL-4: text → int, truncating a decimal fraction ("12.7" → 12).

    Other malformed text ("12x", "1e3") becomes NULL. The fraction is cut
    with a regex first because an ANSI ``try_cast`` rejects "12.7".
    """
    return F.regexp_replace(_col(c), r"^\s*([+-]?\d+)\.\d*\s*$", "$1").try_cast("int")


def parse_date(c: str | Column, fmt: str = DATE_FORMAT) -> Column:
    """CL-6/CL-17: strict ``yyyy-MM-dd`` text → midnight TIMESTAMP_NTZ.

    "2024-1-5", "2024-02-30", a leading blank or a trailing time give NULL.
    """
    return F.try_to_date(_col(c), fmt).cast("timestamp_ntz")


def parse_day(c: str | Column, fmt: str = DATE_FORMAT) -> Column:
    """CL-17 (documented): strict ``yyyy-MM-dd`` text → DATE (NULL if malformed)."""
    return F.try_to_date(_col(c), fmt)


def contactable(email: str | Column, phone: str | Column) -> Column:
    """CL-8: 0 when both contact fields are NULL, else 1 (blank counts as present)."""
    return F.when(_col(email).isNull() & _col(phone).isNull(), F.lit(0)).otherwise(F.lit(1))


def standardize_channel(c: str | Column) -> Column:
    """CL-9: map channel spellings to call / whatsapp / email; others unchanged."""
    c = _col(c)
    expr = None
    for target, spellings in CHANNEL_SYNONYMS:
        cond = c.isin(*spellings)
        expr = F.when(cond, F.lit(target)) if expr is None else expr.when(cond, F.lit(target))
    return expr.otherwise(c)


def strip_special(c: str | Column) -> Column:
    """CL-16: trim + lower, then drop every character outside ``[a-z0-9\\s]``."""
    return F.regexp_replace(norm_lower(c), r"[^a-z0-9\s]", "")


def mask_email(c: str | Column) -> Column:
    """CL-19: keep the domain, replace the local part by its SHA-256 hex digest."""
    c = _col(c)
    local = F.regexp_extract(c, r"^(.*)@([^@]*)$", 1)
    domain = F.regexp_extract(c, r"^(.*)@([^@]*)$", 2)
    return F.when(c.isNull(), F.lit(None).cast("string")).when(
        c.contains("@"), F.concat(F.sha2(local, 256), F.lit("@"), domain)
    ).otherwise(F.sha2(c, 256))


def mask_phone(c: str | Column) -> Column:
    """CL-19: keep the last four digits, star out the other digits, drop the rest."""
    digits = F.regexp_replace(_col(c), r"[^0-9]", "")
    n_hidden = F.greatest(F.length(digits) - F.lit(4), F.lit(0))
    stars = F.repeat(F.lit("*"), n_hidden)
    return F.concat(stars, F.substring(digits, -4, 4))
