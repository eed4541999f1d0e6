"""Calendar expressions."""

from __future__ import annotations

import re
from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F


def month_key(day) -> Column:
    """``YYYY-MM`` text of a date."""
    return F.date_format(day, "yyyy-MM")


def month_start(key) -> Column:
    """First day of a ``YYYY-MM`` key."""
    return F.to_date(F.concat(key, F.lit("-01")))


def days_between(later, earlier) -> Column:
    """Whole days from ``earlier`` to ``later`` as a double."""
    return F.datediff(later, earlier).cast("double")


def months_apart(later_key, earlier_key) -> Column:
    """Number of months between two ``YYYY-MM`` keys."""
    def ordinal(key):
        return F.substring(key, 1, 4).cast("int") * 12 + F.substring(key, 6, 2).cast("int")

    return ordinal(later_key) - ordinal(earlier_key)


def month_bounds(key: str) -> tuple[date, date]:
    """First day of a month and of the month after it; refuses anything but ``YYYY-MM``."""
    match = re.fullmatch(r"(\d{4})-(\d{2})", key or "")
    if not match or not 1 <= int(match[2]) <= 12:
        raise ValueError(f"expected a month written YYYY-MM, got {key!r}")
    year, month = int(match[1]), int(match[2])
    return date(year, month, 1), date(year + month // 12, month % 12 + 1, 1)


def in_month(day, key: str) -> Column:
    """Half-open range test, which reaches the Parquet scan as a pushed filter."""
    first, after = month_bounds(key)
    return (F.col(day) >= F.lit(first)) & (F.col(day) < F.lit(after))


def compact_day_sql(day: str) -> str:
    """A date as ``yyyyMMdd``, out of its plain text, which is cheaper than a format, where years have four digits."""
    usual = f"{day} BETWEEN DATE'0001-01-01' AND DATE'9999-12-31'"
    return f"CASE WHEN {usual} THEN replace(CAST({day} AS STRING), '-', '') ELSE date_format({day}, 'yyyyMMdd') END"
