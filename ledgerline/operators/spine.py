"""Calendar spines."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions import month_start


def _calendar(bounds: DataFrame, first_day, last_day) -> DataFrame:
    days = bounds.select(
        F.explode(F.when(first_day <= last_day, F.sequence(first_day, last_day))).alias("date_day")
    )
    return days.select(
        "date_day",
        month_start(F.col("date_day")).alias("month_start_date"),
        F.last_day("date_day").alias("month_end_date"),
    )


def date_spine(spark: SparkSession, start: dt.date | str, end: dt.date | str) -> DataFrame:
    """One row per day from ``start`` to the day before ``end``."""
    first, stop = (F.lit(str(day)).cast("date") for day in (start, end))
    return _calendar(spark.range(1), first, F.date_sub(stop, 1))


def date_spine_over(df: DataFrame, day: str) -> DataFrame:
    """One row per day of the whole months that the dates in column ``day`` reach."""
    bounds = df.agg(F.min(day).alias("first_day"), F.max(day).alias("last_day"))
    return _calendar(bounds, month_start(F.col("first_day")), F.last_day("last_day"))


def date_spine_covering(coverage: DataFrame, first: str, last: str) -> DataFrame:
    """One row per day of the whole months between two dates of a one-row table."""
    return _calendar(coverage, month_start(F.col(first)), F.last_day(last))


def months_of(dates: DataFrame) -> DataFrame:
    return dates.select("month_start_date", "month_end_date").distinct()
