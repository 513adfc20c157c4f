"""Named metrics over the transaction fact, at any slice, and month roll-ups."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F


@dataclass(frozen=True)
class Measure:
    """A sum or a count of ``value`` over the fact, placed in time by ``time``."""

    value: Callable[[], Column]
    time: str = "recognition_date"
    counts: bool = False


@dataclass(frozen=True)
class Ratio:
    numerator: str
    denominator: str


def _recognised(amount: str, and_where: str = "true") -> Callable[[], Column]:
    return lambda: F.when(
        (F.col("is_revenue_recognised") == 1) & F.expr(and_where), F.col(amount)
    ).otherwise(0)


METRICS: dict[str, Measure | Ratio] = {
    "revenue": Measure(lambda: F.col("revenue_gbp")),
    "net_gmv": Measure(_recognised("net_amount_gbp")),
    "gross_gmv": Measure(_recognised("gross_amount_gbp", "amount_direction = 1")),
    "take_rate": Ratio("revenue", "net_gmv"),
    "transactions": Measure(
        lambda: F.col("transaction_id"), time="transaction_date", counts=True
    ),
}
DIMENSIONS = [
    "client_id",
    "transaction_type",
    "transaction_currency",
    "is_duplicate_refund",
    "recognition_date",
    "transaction_date",
]
GRAINS = ["day", "week", "month", "quarter", "year"]


def _needed(metrics: Iterable[str]) -> list[str]:
    names: list[str] = []
    for name in metrics:
        metric = METRICS[name]
        parts = [metric.numerator, metric.denominator] if isinstance(metric, Ratio) else [name]
        names += [part for part in parts if part not in names]
    return names


def _at_grain(day: str, grain: str) -> Column:
    return F.col(day) if grain == "day" else F.trunc(F.col(day), grain)


def metric_query(
    fct: DataFrame,
    metrics: Iterable[str],
    group_by: Iterable[str] = (),
    time_grain: str | None = None,
    where: str | Column | None = None,
) -> DataFrame:
    """Evaluate ``metrics`` by the dimensions ``group_by``.

    With ``time_grain`` the result is also by ``metric_time``: each metric by its own
    date, so one call may mix metrics by recognition and by transaction date. A metric
    without rows in a group is NULL there, and rows without the date are left out. The
    fact is read and shuffled once, whatever the dates.
    """
    metrics, group_by = list(metrics), list(group_by)
    for name in metrics:
        if name not in METRICS:
            raise ValueError(f"unknown metric {name!r}, known are {sorted(METRICS)}")
    for name in group_by:
        if name not in DIMENSIONS:
            raise ValueError(f"unknown dimension {name!r}, known are {DIMENSIONS}")
    if time_grain is not None and time_grain not in GRAINS:
        raise ValueError(f"unknown grain {time_grain!r}, known are {GRAINS}")

    rows = fct if where is None else fct.where(where)
    needed = {name: METRICS[name] for name in _needed(metrics)}
    keys = list(group_by)
    if time_grain is not None:
        keys = ["metric_time", *keys]
        days = sorted({measure.time for measure in needed.values()})
        times = F.array_distinct(F.array_compact(F.array(*(_at_grain(d, time_grain) for d in days))))
        rows = rows.withColumn("metric_time", F.explode(times))

    def total(measure: Measure) -> Column:
        value = measure.value()
        if time_grain is None:
            return F.count(value) if measure.counts else F.sum(value)
        here = F.col("metric_time") == _at_grain(measure.time, time_grain)
        if measure.counts:
            return F.sum(F.when(here, F.when(value.isNotNull(), 1).otherwise(0)))
        return F.sum(F.when(here, value))

    totals = rows.groupBy(*keys).agg(*(total(m).alias(name) for name, m in needed.items()))

    def result(name: str) -> Column:
        metric = METRICS[name]
        if isinstance(metric, Ratio):
            parts = (F.col(c).cast("double") for c in (metric.numerator, metric.denominator))
            return F.try_divide(*parts).alias(name)
        return F.col(name)

    return totals.select(*keys, *(result(name) for name in metrics))


def rollup_months(
    monthly: DataFrame,
    grain: str,
    columns: Iterable[str] | None = None,
    by_client: bool = True,
) -> DataFrame:
    """Roll the monthly mart up to quarters or years, and over clients if asked to.

    The columns' additivity is read from their metadata. Additive columns are summed.
    Semi-additive ones are positions at a month's end: the last month of the period
    counts, and only clients are summed. Non-additive columns are refused.
    """
    if grain not in ("quarter", "year"):
        raise ValueError(f"cannot roll months up to {grain!r}")
    additivity = {
        field.name: field.metadata["additivity"]
        for field in monthly.schema.fields
        if "additivity" in field.metadata
    }
    if columns is None:
        columns = [c for c, kind in additivity.items() if kind != "non_additive"]
    columns = list(columns)
    for name in columns:
        if additivity.get(name, "non_additive") == "non_additive":
            raise ValueError(f"{name} cannot be rolled up")

    period = F.trunc("month_start_date", grain).alias("period_start_date")
    per_client = monthly.groupBy("client_id", period).agg(
        *(
            (
                F.sum(c) if additivity[c] == "additive" else F.max_by(c, "month_start_date")
            ).alias(c)
            for c in columns
        )
    )
    if by_client:
        return per_client
    return per_client.groupBy("period_start_date").agg(*(F.sum(c).alias(c) for c in columns))
