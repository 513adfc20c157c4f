"""Small helpers on tables that several operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

#: Rows of (long, long) that may be broadcast: 16 MB of values.
BROADCAST_ROWS = 1_000_000


def checked_broadcast(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """Marks a slim table for broadcast if it has at most ``rows`` rows; otherwise it stays as it
    is and Spark shuffles. The table should be written or cheap, as it is counted."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def unsigned_remainder(key: str, divisor: int) -> Column:
    """crc32 of the key as text, modulo ``divisor``; NULL for a NULL key."""
    return F.pmod(F.crc32(F.col(key).cast("string").cast("binary")), F.lit(divisor))


def partition_starts(
    df: DataFrame, part: str, amounts: list[str], groups: list[str] | None = None
) -> DataFrame:
    """For each value of ``part`` (and group), the sums of ``amounts`` over all lower parts.

    The window runs over one row for each part and group, not over rows of the table.
    """
    groups = groups or []
    from pyspark.sql import Window

    sums = df.groupBy(*groups, part).agg(*(F.sum(a).alias(a) for a in amounts))
    before = Window.partitionBy(*groups).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    return sums.select(
        *groups,
        part,
        *(F.coalesce(F.sum(a).over(before), F.lit(0)).alias(f"{a}_before") for a in amounts),
    )


def long_field(*names: str) -> list[T.StructField]:
    return [T.StructField(name, T.LongType()) for name in names]
