"""Running totals in an order of day and id, by distributed prefix sums, safe for a key of any size.

A plain window by key would sort all rows of a key in one task. Here the ledger is ranged by key, day and
id and written with the number of each row's part: neighbours in the order lie in one part, and a key, a day
or any kind of ids fills as many parts as its rows need. Sums by key and part, run over the
parts of a key, open each part; within it the rows are windowed on top of that.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from .cuts import cut

PART = "_part"


def add_totals(left: Column, right: Column) -> Column:
    """Sum of two totals, NULL only if both are: what one running sum would have given."""
    return F.when(left.isNull(), right).when(right.isNull(), left).otherwise(left + right)


def in_parts(ledger: DataFrame, *, key: str, day: str, row_id: str) -> DataFrame:
    """The ledger as a cut table in the order (key, day, id), with each row's part. Only rows equal in all
    three cannot be parted. Spark chooses the number of parts as for any shuffle."""
    ranged = ledger.repartitionByRange(key, day, row_id)
    return cut(ranged.withColumn(PART, F.spark_partition_id()), "ledger-parts")


def _before(key: str, column: str) -> Column:
    """The sum over the parts of a key before this one."""
    parts = Window.partitionBy(key).orderBy(PART)
    return F.sum(column).over(parts.rowsBetween(Window.unboundedPreceding, -1))


def _within(rows: DataFrame, key: str, day: str, row_id: str, value: str) -> Column:
    order = Window.partitionBy(key, PART).orderBy(day, row_id)
    inside = F.sum(value).over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return add_totals(F.col("_opening"), inside)


def running_total(
    parts: DataFrame, *, key: str, day: str, row_id: str, value: str, out: str
) -> DataFrame:
    """Add ``out``, the running sum of ``value`` per ``key`` in the order (day, id), to a ledger from
    ``in_parts``. Keys must not be NULL."""
    sums = parts.groupBy(key, PART).agg(F.sum(value).alias("_net"))
    opening = sums.select(key, PART, _before(key, "_net").alias("_opening"))
    met = parts.join(opening, [key, PART])
    return met.withColumn(out, _within(met, key, day, row_id, value)).drop(PART, "_opening")


def first_crossing(
    parts: DataFrame, *, key: str, day: str, row_id: str, value: str, threshold: str
) -> DataFrame:
    """Per key with any value the places (day, id) of two rows of a ledger from ``in_parts``: ``first_value``, the
    first one with a value, and ``crossing``, at which the running sum of ``value`` first
    reaches ``threshold``.

    Only those parts are looked into in which the sum may reach the threshold for the first time: they reach
    it counting their positive values alone, and no part before ends at or above it.
    """
    here = place(F.col(day), F.col(row_id))
    by_key = Window.partitionBy(key)
    sums = parts.groupBy(key, PART).agg(
        F.sum(value).alias("_net"),
        F.sum(F.greatest(F.col(value), F.lit(0))).alias("_up"),
        F.min(threshold).alias("_least"),
        F.min(F.when(F.col(value).isNotNull(), here)).alias("first_value"),
    )
    opened = cut(sums.withColumn("_opening", _before(key, "_net")), "part-sums")
    closes_above = add_totals(F.col("_opening"), F.col("_net")) >= F.col("_least")
    reaches = add_totals(F.col("_opening"), F.col("_up")) >= F.col("_least")
    settled = F.min(F.when(closes_above, F.col(PART))).over(by_key)
    candidates = opened.withColumn("_settled", settled).where(
        reaches & (F.col("_settled").isNull() | (F.col(PART) <= F.col("_settled")))
    )
    rows = parts.join(candidates.select(key, PART, "_opening"), [key, PART])
    total = rows.withColumn("_total", _within(rows, key, day, row_id, value))
    crossings = total.where(F.col("_total") >= F.col(threshold)).groupBy(key)
    valued = opened.groupBy(key).agg(F.min("first_value").alias("first_value"))
    return valued.where("first_value is not null").join(
        crossings.agg(F.min(here).alias("crossing")), key, "left"
    )


def place(day: Column, row_id: Column) -> Column:
    """Where a row stands in the order of a running total."""
    return F.struct(day.alias("day"), row_id.alias("id"))
