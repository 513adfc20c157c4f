"""Checks on DataFrames. Each returns its failing rows, so an empty result is a pass."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..operators.cuts import cut


def _scope(df: DataFrame, where: str | None) -> DataFrame:
    return df if where is None else df.where(where)


# Conditions on one row. NULL is never a failure, except to not_null.


def null_fails(column: str) -> Column:
    return F.col(column).isNull()


def value_fails(column: str, values: Iterable) -> Column:
    return ~F.col(column).isin(list(values))


def range_fails(
    column: str, min_value=None, max_value=None, inclusive: bool = True
) -> Column:
    value, fails = F.col(column), F.lit(False)
    if min_value is not None:
        fails = fails | (value < min_value if inclusive else value <= min_value)
    if max_value is not None:
        fails = fails | (value > max_value if inclusive else value >= max_value)
    return fails


def expression_fails(expression: str, column: str | None = None) -> Column:
    """``expression`` is a whole SQL condition, or what follows ``column`` in one, such
    as ``> 0`` or ``is null``."""
    return ~F.expr(expression if column is None else f"{column} {expression}")


def not_null(df: DataFrame, column: str, where: str | None = None) -> DataFrame:
    return _scope(df, where).where(null_fails(column))


def accepted_values(
    df: DataFrame, column: str, values: Iterable, where: str | None = None
) -> DataFrame:
    """One row per value that is not accepted, with the number of its rows."""
    failing = _scope(df, where).where(value_fails(column, values))
    return failing.groupBy(column).agg(F.count(F.lit(1)).alias("n_records"))


def accepted_range(
    df: DataFrame,
    column: str,
    min_value=None,
    max_value=None,
    inclusive: bool = True,
    where: str | None = None,
) -> DataFrame:
    return _scope(df, where).where(range_fails(column, min_value, max_value, inclusive))


def expression_is_true(
    df: DataFrame, expression: str, column: str | None = None, where: str | None = None
) -> DataFrame:
    return _scope(df, where).where(expression_fails(expression, column))


def unique(df: DataFrame, column: str, where: str | None = None) -> DataFrame:
    """One row per value that occurs more than once, with the number of its rows."""
    counts = (
        _scope(df, where)
        .where(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("n_records"))
    )
    return counts.where(F.col("n_records") > 1)


def missing_values(
    df: DataFrame,
    column: str,
    parent: DataFrame,
    field: str,
    where: str | None = None,
    parent_where: str | None = None,
) -> DataFrame:
    """One row per value absent in the parent's field, with the number of its rows.

    Both sides are reduced to distinct values before they meet, so a frequent value or a
    parent that repeats its values costs nothing.
    """
    values = (
        _scope(df, where)
        .where(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("n_records"))
    )
    known = _scope(parent, parent_where).select(F.col(field).alias(column)).distinct()
    return values.join(known, column, "left_anti")


def relationships(
    df: DataFrame,
    column: str,
    parent: DataFrame,
    field: str,
    where: str | None = None,
    parent_where: str | None = None,
) -> DataFrame:
    """The rows whose value is absent in the parent's field; ``parent_where`` limits the
    parent rows that count. The absent values are written first: they are few as a rule,
    and Spark then sees that ``df`` need not be shuffled to find its rows with them."""
    missing = missing_values(df, column, parent, field, where, parent_where)
    return _scope(df, where).join(cut(missing.select(column), "missing"), column, "left_semi")


def equal_rowcount(df: DataFrame, other: DataFrame) -> DataFrame:
    """One row with both counts if they differ."""
    rows = F.count(F.lit(1))
    counts = df.agg(rows.alias("row_count")).withColumn(
        "other_row_count", other.agg(rows.alias("row_count")).scalar()
    )
    difference = F.abs(F.col("row_count") - F.col("other_row_count"))
    return counts.withColumn("difference", difference).where(F.col("difference") > 0)


def sequence_is_daily(df: DataFrame, key: str, day: str) -> DataFrame:
    """The rows whose previous row of the same key is not of the day before.

    A key has as many days as the calendar; repeated days are reduced to their count
    first, so the window never holds more.
    """
    days = df.groupBy(key, day).agg(F.count(F.lit(1)).alias("copies"))
    previous = F.lag(day).over(Window.partitionBy(key).orderBy(day))
    gaps = days.withColumn(f"previous_{day}", previous).where(
        F.col(f"previous_{day}").isNotNull() & (F.col(day) != F.date_add(f"previous_{day}", 1))
    )
    repeats = days.where((F.col("copies") > 1) & F.col(day).isNotNull()).select(
        key, day, F.col(day).alias(f"previous_{day}")
    )
    return gaps.select(key, day, f"previous_{day}").unionByName(repeats)


def reconcile(monthly: DataFrame, fct: DataFrame, tolerance: float = 0.001) -> DataFrame:
    """The clients whose monthly totals differ from the transaction fact: revenue and net
    GMV on both bases, and the last month's contract spend to date."""
    spend = F.col("cumulative_contract_spend_gbp")
    months = monthly.groupBy("client_id").agg(
        *(
            F.sum(c).alias(c)
            for c in (
                "recognised_revenue_gbp",
                "originated_revenue_gbp",
                "recognised_net_gmv_gbp",
                "originated_net_gmv_gbp",
            )
        ),
        # the mart is dense, so a client's last month is the last month of all
        F.max_by(spend, "month_start_date").alias("cumulative_contract_spend_gbp"),
    )
    recognised_net = F.when(F.col("is_revenue_recognised") == 1, F.col("net_amount_gbp"))
    transactions = fct.groupBy("client_id").agg(
        F.sum("revenue_gbp").alias("revenue_gbp"),
        F.sum(recognised_net.otherwise(0)).alias("net_gmv_gbp"),
        F.sum("contract_spend_gbp").alias("contract_spend_gbp"),
    )

    def differ(left: Column, right: Column) -> Column:
        return F.abs(left - right) > tolerance

    revenue, net = F.col("revenue_gbp"), F.col("net_gmv_gbp")
    return months.join(transactions, "client_id").where(
        differ(F.col("recognised_revenue_gbp"), revenue)
        | differ(F.col("originated_revenue_gbp"), revenue)
        | differ(F.col("recognised_net_gmv_gbp"), net)
        | differ(F.col("originated_net_gmv_gbp"), net)
        | differ(
            F.coalesce("cumulative_contract_spend_gbp", F.lit(0)),
            F.coalesce("contract_spend_gbp", F.lit(0)),
        )
    )
