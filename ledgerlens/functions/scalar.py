"""Scalar column helpers: text cleaning, dates and safe arithmetic."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F


def col_or_lit(x) -> Column:
    if isinstance(x, Column):
        return x
    if isinstance(x, str):
        return F.col(x)
    return F.lit(x)


# ---- text ------------------------------------------------------------------

def clean_lower(c) -> Column:
    """LOWER(TRIM(x))."""
    return F.lower(F.trim(col_or_lit(c)))


def clean_upper(c) -> Column:
    return F.upper(F.trim(col_or_lit(c)))


def clean_title(c) -> Column:
    """INITCAP(TRIM(x)); words are split on whitespace only."""
    return F.initcap(F.trim(col_or_lit(c)))


def digits_and_plus(c) -> Column:
    """REGEXP_REPLACE(phone, '[^0-9+]', '') - every match removed."""
    return F.regexp_replace(col_or_lit(c), r"[^0-9+]", "")


def join_words(*cols) -> Column:
    """a || ' ' || b: null if any part is null (concat, not concat_ws)."""
    parts = []
    for i, c in enumerate(cols):
        if i:
            parts.append(F.lit(" "))
        parts.append(col_or_lit(c))
    return F.concat(*parts)


# ---- dates -----------------------------------------------------------------

def days_between(start, end) -> Column:
    """DATEDIFF('day', start, end) as bigint (end - start)."""
    return F.datediff(col_or_lit(end), col_or_lit(start)).cast("bigint")


def month_start(d) -> Column:
    """DATE_TRUNC('month', d) kept as DATE."""
    return F.trunc(col_or_lit(d), "month")


def quarter_start(d) -> Column:
    return F.trunc(col_or_lit(d), "quarter")


def year_start(d) -> Column:
    return F.trunc(col_or_lit(d), "year")


def in_year(d, year: int) -> Column:
    """Whether a date lies in a year (F9), as a range that reaches the scan and prunes partitions."""
    return (col_or_lit(d) >= F.lit(dt.date(year, 1, 1))) & (col_or_lit(d) < F.lit(dt.date(year + 1, 1, 1)))


def as_date_lit(d) -> Column:
    if isinstance(d, Column):
        return d
    if d is None:
        return F.current_date()
    if isinstance(d, str):
        d = dt.date.fromisoformat(d)
    return F.lit(d)


def as_ts_lit(ts) -> Column:
    """Run timestamp literal (timestamp_ntz, UTC wall clock)."""
    if isinstance(ts, Column):
        return ts
    if ts is None:
        return F.current_timestamp().cast("timestamp_ntz")
    if isinstance(ts, str):
        ts = dt.datetime.fromisoformat(ts)
    if isinstance(ts, dt.date) and not isinstance(ts, dt.datetime):
        ts = dt.datetime.combine(ts, dt.time())
    # Through ISO text: a Python datetime literal would be read in the
    # process time zone and shifted by the session zone on the cast.
    return F.lit(ts.replace(tzinfo=None).isoformat(sep=" ")).cast("timestamp_ntz")


def utc_now() -> Column:
    """CONVERT_TIMEZONE('UTC', CURRENT_TIMESTAMP())::TIMESTAMP_NTZ."""
    # Source zone omitted = the session zone the wall-clock cast used.
    return F.convert_timezone(None, F.lit("UTC"), F.current_timestamp().cast("timestamp_ntz"))


# ---- arithmetic ------------------------------------------------------------

def safe_divide(num, den, alt=None) -> Column:
    """DIVIDE(a, b[, alt]): ``alt`` (default null = blank) when the
    denominator is zero or blank; a blank numerator gives blank.

    Arguments are divided as doubles so the result type is stable and no
    ANSI divide-by-zero error can be raised.
    """
    n = col_or_lit(num).cast("double")
    d = col_or_lit(den).cast("double")
    alt_c = F.lit(alt).cast("double")
    return F.when(d.isNull() | (d == 0), alt_c).otherwise(n / d)


def pct_of(num, den, scale: int = 2) -> Column:
    """ROUND(num * 100 / NULLIF(den, 0), scale) computed in decimal.

    The numerator is cast to decimal(28,4) so Spark keeps 10 fractional
    digits in the quotient before the final HALF_UP rounding.
    """
    n = (col_or_lit(num) * F.lit(100)).cast("decimal(28,4)")
    d = col_or_lit(den).cast("decimal(18,4)")
    return F.round(n / F.nullif(d, F.lit(Decimal(0))), scale)
