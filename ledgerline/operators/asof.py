"""As-of lookup: the latest value on or before a date."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from .cuts import cut


def value_periods(values: DataFrame, key: str, day: str, value: str) -> DataFrame:
    """Each value with the day its successor takes over, NULL for the last one.

    Of several values on one day the highest counts, so a key has as many rows as the
    calendar has days, however often values are delivered.
    """
    successor = Window.partitionBy(key).orderBy(day)
    return (
        values.where(F.col(day).isNotNull())
        .groupBy(key, day)
        .agg(F.max(value).alias(value))
        .withColumn("next_day", F.lead(day).over(successor))
    )


def daily_values(values: DataFrame, key: str, day: str, value: str) -> DataFrame:
    """One row per key and day, from its first value to the last day any key has one.

    The size is bounded by the calendar times the number of keys, however many rows
    look values up.
    """
    last_day = values.agg(F.max(day)).scalar()
    until = F.date_sub(F.coalesce("next_day", F.date_add(last_day, 1)), 1)
    return value_periods(values, key, day, value).select(
        key, F.explode(F.sequence(F.col(day), until)).alias(day), value
    )


def daily_lookup(values: DataFrame, key: str, day: str, value: str) -> DataFrame:
    """``daily_values`` as a cut table, for ``asof_join`` to use any number of times."""
    return cut(daily_values(values, key, day, value), "daily-values")


def asof_join(
    rows: DataFrame, daily: DataFrame, *, key: tuple[str, str], day: tuple[str, str], value: str
) -> DataFrame:
    """Add to ``rows`` the latest ``value`` of its key on or before its day.

    ``key`` and ``day`` name the columns in ``rows`` and in ``daily``, a ``daily_lookup``.
    The last value carries forward and a day before the first one gets NULL. Every row
    probes one (key, day), since days after the last value look at the last day.
    """
    (row_key, daily_key), (row_day, daily_day) = key, day
    last_day = daily.agg(F.max(daily_day)).scalar()
    lookup = daily.select(
        F.col(daily_key).alias("_key"), F.col(daily_day).alias("_day"), F.col(value)
    )
    # least() skips NULLs, hence the guard for rows without a day
    probe = F.when(F.col(row_day).isNotNull(), F.least(F.col(row_day), last_day))
    return (
        rows.withColumn("_probe", probe)
        .join(lookup, (F.col(row_key) == F.col("_key")) & (F.col("_probe") == F.col("_day")), "left")
        .drop("_key", "_day", "_probe")
    )
