"""Row-level feature expressions (built-in functions only).

Time is a count of seconds from an unknown base date, so hour and day are
plain integer arithmetic; no time zone is involved.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .rounding import half_away

# Thresholds of the engineered flags.
NIGHT_DAY_START_HOUR = 6      # day hours are 6..21 inclusive; night is 22..5
NIGHT_DAY_END_HOUR = 21
WEEKEND_DAYS = (5, 6)         # day index from the unknown base date
LARGE_AMOUNT = 150
SECONDS_PER_HOUR = 3600
SECONDS_PER_DAY = 86400


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def tx_hour(dt="TransactionDT") -> Column:
    """Hour of day 0..23: ``CAST(FLOOR(dt / 3600) % 24 AS INT)``."""
    return (F.floor(_col(dt) / F.lit(float(SECONDS_PER_HOUR))) % 24).cast("int")


def tx_day_of_week(dt="TransactionDT") -> Column:
    """Day index 0..6 from the base date: ``CAST(FLOOR(dt / 86400) % 7 AS INT)``."""
    return (F.floor(_col(dt) / F.lit(float(SECONDS_PER_DAY))) % 7).cast("int")


def tx_day(dt="TransactionDT") -> Column:
    """Day number from the base date."""
    return F.floor(_col(dt) / F.lit(float(SECONDS_PER_DAY))).cast("int")


def flag(cond: Column) -> Column:
    """1 when ``cond`` is true, else 0 (also 0 when ``cond`` is NULL)."""
    return F.when(cond, F.lit(1)).otherwise(F.lit(0))


def is_night(hour="tx_hour") -> Column:
    return flag(~_col(hour).between(NIGHT_DAY_START_HOUR, NIGHT_DAY_END_HOUR))


def is_weekend(day_of_week="tx_day_of_week") -> Column:
    return flag(_col(day_of_week).isin(*WEEKEND_DAYS))


def is_large(amount="TransactionAmt", threshold: float = LARGE_AMOUNT) -> Column:
    return flag(_col(amount) > F.lit(threshold))


def log_amount(amount="TransactionAmt") -> Column:
    """``LN(1 + GREATEST(amount, 0))``; a sentinel amount gives 0."""
    return F.ln(F.lit(1.0) + F.greatest(_col(amount), F.lit(0.0)))


def zscore(amount, avg, std, digits: int = 2) -> Column:
    """Deviation of a row from its group mean, in standard deviations.

    -999 when the mean is NULL or not positive; NULL when the standard
    deviation is NULL or 0 (and the mean is positive).
    """
    a, m, s = _col(amount), _col(avg), _col(std)
    dev = half_away((a - m) / F.nullif(s, F.lit(0.0)), digits)
    return F.when(m.isNotNull() & (m > 0), dev).otherwise(F.lit(-999.0))


def safe_divide(num, den) -> Column:
    """NULL instead of an error when ``den`` is 0 or NULL."""
    return F.try_divide(_col(num).cast("double"), F.nullif(_col(den).cast("double"), F.lit(0.0)))
