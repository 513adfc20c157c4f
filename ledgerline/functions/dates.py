"""Date expressions. Malformed text gives NULL, also under ANSI mode."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def iso_date(text: Column) -> Column:
    """``YYYY-MM-DD`` text (or a date) as a date. The length test keeps out the
    short forms Spark's cast would take, such as ``2024`` and ``2024-1-5``."""
    return F.when(F.length(text) >= 10, text.try_cast("date"))


def slashed_date(text: Column) -> Column:
    """``dd/mm/yyyy`` text as a date; empty text is NULL."""
    return F.try_to_date(F.nullif(text, F.lit("")), "dd/MM/yyyy")


def month_start(day: Column) -> Column:
    return F.trunc(day, "month")


def add_months_overflow(day: Column, months: Column, clamp: bool = False) -> Column:
    """``day`` plus ``months``. A day the target month lacks runs over into the next
    month (31 January + 1 month = 2 March in a leap year); with ``clamp`` it stops
    at the month's last day instead."""
    if clamp:
        return F.add_months(day, months)
    return F.date_add(F.add_months(month_start(day), months), F.dayofmonth(day) - 1)
