"""Client by month: the dense revenue mart, its parts and the naive spend comparison."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions import month_start, surrogate_key
from ..operators.cuts import cut
from ..operators.spine import months_of
from ..schemas import ADDITIVITY

COVERAGE = ["data_start_date", "data_end_date"]
MONTHLY = [
    "client_month_id",
    "client_id",
    "month_start_date",
    "month_end_date",
    "is_partial_month",
    "recognised_gross_gmv_gbp",
    "recognised_net_gmv_gbp",
    "recognised_revenue_gbp",
    "recognised_transaction_count",
    "originated_net_gmv_gbp",
    "originated_revenue_gbp",
    "pending_chargebacks_gbp",
    "contract_status",
    "spend_threshold",
    "monthly_contract_spend_gbp",
    "cumulative_contract_spend_gbp",
    "pct_of_spend_threshold",
    "discount_earned_date",
    "is_discount_active",
]


def _recognised() -> Column:
    return F.col("is_revenue_recognised") == 1


def _inflow() -> Column:
    """The gross amount of money coming in, 0 for money going out."""
    return F.when(F.col("amount_direction") == 1, F.col("gross_amount_gbp")).otherwise(0)


def _by_month(fct: DataFrame, day: str, *measures: Column) -> DataFrame:
    return fct.groupBy("client_id", month_start(F.col(day)).alias("month_start_date")).agg(
        *measures
    )


def recognised_by_month(fct: DataFrame) -> DataFrame:
    return _by_month(
        fct.where(_recognised()),
        "recognition_date",
        F.sum(_inflow()).alias("recognised_gross_gmv_gbp"),
        F.sum("net_amount_gbp").alias("recognised_net_gmv_gbp"),
        F.sum("revenue_gbp").alias("recognised_revenue_gbp"),
        F.count(F.lit(1)).alias("recognised_transaction_count"),
    )


def originated_by_month(fct: DataFrame) -> DataFrame:
    return _by_month(
        fct.where(_recognised()),
        "transaction_date",
        F.sum("net_amount_gbp").alias("originated_net_gmv_gbp"),
        F.sum("revenue_gbp").alias("originated_revenue_gbp"),
    )


def contract_spend_by_month(fct: DataFrame) -> DataFrame:
    return _by_month(
        fct.where(F.col("contract_spend_gbp").isNotNull()),
        "spend_effective_date",
        F.sum("contract_spend_gbp").alias("monthly_contract_spend_gbp"),
    )


def discount_earned_date(fct: DataFrame) -> DataFrame:
    return (
        fct.where(F.col("is_discount_earned") == 1)
        .groupBy("client_id")
        .agg(F.min("spend_effective_date").alias("discount_earned_date"))
    )


def data_coverage(fct: DataFrame) -> DataFrame:
    """One row: the first transaction date and the last date of any activity."""
    last = F.greatest(F.max("transaction_date"), F.max("resolution_date"))
    columns = (F.min("transaction_date"), last)
    return fct.agg(*(column.alias(name) for column, name in zip(columns, COVERAGE)))


def reporting_months(dates: DataFrame, coverage: DataFrame) -> DataFrame:
    """The months of the spine that the data covers."""
    first, last = (month_start(coverage.select(c).scalar()) for c in COVERAGE)
    return months_of(dates).where(F.col("month_start_date").between(first, last))


def _span(dates: DataFrame, coverage: DataFrame) -> tuple[Column, Column]:
    """The first and the last month reported, as scalar subqueries."""
    months = reporting_months(dates, coverage)
    return tuple(
        months.agg(edge("month_start_date").alias("month")).scalar() for edge in (F.min, F.max)
    )


def client_month_scaffold(clients: DataFrame, dates: DataFrame, coverage: DataFrame) -> DataFrame:
    """Every client in every month the data covers. The spine is taken to have no gaps."""
    first, last = _span(dates, coverage)
    months = F.sequence(first, last, F.expr("INTERVAL 1 MONTH"))
    return (
        clients.select("client_id")
        .distinct()
        .select("client_id", F.explode(months).alias("month_start_date"))
        .withColumn("month_end_date", F.last_day("month_start_date"))
    )


def _distinct_months(first: Column, *others: Column) -> Column:
    """Entries with each month once, those that do not count NULL; where no month is known, the first has NULL. They
    are left out as rows: array_compact would run outside generated code."""
    unknown = reduce(Column.__and__, (month.isNull() for month in (first, *others)))
    entries, before = [F.when(first.isNotNull() | unknown, F.struct(first.alias("day")))], [first]
    for month in others:
        is_new = reduce(Column.__and__, (~month.eqNullSafe(m) for m in before), month.isNotNull())
        entries.append(F.when(is_new, F.struct(month.alias("day"))))
        before.append(month)
    return F.array(*entries)


def monthly_activity(fct: DataFrame) -> DataFrame:
    """All measures of the mart per client and month with activity, in one aggregate.

    A transaction counts in the months of its transaction, recognition and effective
    dates, mostly one and the same, so few rows are emitted twice. A chargeback adds to
    pending exposure in its own month and takes that back in the month it resolves: the
    running total of these changes is what is pending at each month end, however long
    it stays so.
    """
    transacted = month_start(F.col("transaction_date"))
    recognised = month_start(F.col("recognition_date"))
    effective = month_start(F.col("spend_effective_date"))
    requires_resolution = F.col("resolution_status").isNotNull()
    pending_from = F.when(requires_resolution, transacted)
    pending_until = F.when(
        requires_resolution & F.col("resolution_date").isNotNull() & transacted.isNotNull(),
        F.greatest(transacted, month_start(F.col("resolution_date"))),
    )
    months = _distinct_months(transacted, recognised, effective, pending_until)
    rows = fct.select(
        "*",
        transacted.alias("_transacted"),
        recognised.alias("_recognised"),
        effective.alias("_effective"),
        pending_from.alias("_pending_from"),
        pending_until.alias("_pending_until"),
        F.explode(months).alias("_month"),
    )
    rows = rows.where(F.col("_month").isNotNull()).withColumn("month_start_date", F.col("_month.day"))

    def in_month(of: str, value: Column, where: Column | None = None) -> Column:
        here = F.col(of) == F.col("month_start_date")
        return F.when(here if where is None else here & where, value)

    gross, net, revenue = (
        F.col(c) for c in ("gross_amount_gbp", "net_amount_gbp", "revenue_gbp")
    )
    pending_in, pending_out = (
        F.coalesce(F.sum(in_month(of, gross)), F.lit(0))
        for of in ("_pending_from", "_pending_until")
    )
    measures = {
        "recognised_gross_gmv_gbp": F.sum(in_month("_recognised", _inflow(), _recognised())),
        "recognised_net_gmv_gbp": F.sum(in_month("_recognised", net, _recognised())),
        "recognised_revenue_gbp": F.sum(in_month("_recognised", revenue, _recognised())),
        "recognised_transaction_count": F.count(in_month("_recognised", F.lit(1), _recognised())),
        "originated_net_gmv_gbp": F.sum(in_month("_transacted", net, _recognised())),
        "originated_revenue_gbp": F.sum(in_month("_transacted", revenue, _recognised())),
        "monthly_contract_spend_gbp": F.sum(in_month("_effective", F.col("contract_spend_gbp"))),
        "pending_change_gbp": pending_in - pending_out,
        "pending_change_count": F.count(in_month("_pending_from", F.lit(1)))
        - F.count(in_month("_pending_until", F.lit(1))),
        "pending_valued_count": F.count(in_month("_pending_from", gross))
        - F.count(in_month("_pending_until", gross)),
        "discount_earned_date": F.min(
            F.when(F.col("is_discount_earned") == 1, F.col("spend_effective_date"))
        ),
        "data_start_date": F.min("transaction_date"),
        "data_end_date": F.greatest(F.max("transaction_date"), F.max("resolution_date")),
    }
    return rows.groupBy("client_id", "month_start_date").agg(
        *(column.alias(name) for name, column in measures.items())
    )


FLOWS = [
    "recognised_gross_gmv_gbp",
    "recognised_net_gmv_gbp",
    "recognised_revenue_gbp",
    "recognised_transaction_count",
    "originated_net_gmv_gbp",
    "originated_revenue_gbp",
    "monthly_contract_spend_gbp",
]
CHANGES = ["pending_change_gbp", "pending_change_count", "pending_valued_count"]


def _coverage_of(activity: DataFrame) -> DataFrame:
    return activity.agg(
        F.min("data_start_date").alias("data_start_date"),
        F.max("data_end_date").alias("data_end_date"),
    )


def _dense(
    activity: DataFrame,
    dates: DataFrame,
    coverage: DataFrame,
    flows: list[str],
    of_client: DataFrame | None = None,
) -> DataFrame:
    """Activity of every client in every covered month, with running totals and the columns ``of_client`` has
    for the client.

    Each row of a client with activity also fills the months up to its next one, so the
    rows shuffled and sorted are those with activity, once, by client: the totals run over
    them and stay as they are in the months filled. A client has as many as the
    calendar has months. The spine is taken to have no gaps. The rows filled are many times those shuffled, so
    the number of parts is not left to the size of the latter, and what is known of the client joins before.
    """
    month = F.col("month_start_date")
    first, last = _span(dates, coverage)
    covered = month.between(first, last)
    # Activity outside the months reported only shows that the client exists, but what
    # was pending before the first of them still is. So only the rows of the first month
    # come together from several months; the others are one by client and month already.
    as_it_is = F.coalesce(covered & (month > first), F.lit(False))
    at_first = (
        activity.where(first.isNotNull() & ~as_it_is)
        .select(
            "client_id",
            *(F.when(covered, F.col(c)).alias(c) for c in flows),
            *(F.when(covered | (month < first), F.col(c)).alias(c) for c in CHANGES),
            "discount_earned_date",
        )
        .groupBy("client_id")
        .agg(
            *(F.sum(c).alias(c) for c in [*flows, *CHANGES]),
            F.min("discount_earned_date").alias("discount_earned_date"),
        )
        .withColumn("month_start_date", first)
    )
    later = activity.where(as_it_is).select(*at_first.columns)
    parts = int(activity.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = later.unionByName(at_first).repartition(parts, "client_id")
    client = Window.partitionBy("client_id")
    by_month = client.orderBy("month_start_date")
    so_far = by_month.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    is_first = F.lag("month_start_date").over(by_month).isNull()
    following = F.add_months(F.lead("month_start_date").over(by_month), -1)
    totals = {
        "pending_change_gbp": "pending_chargebacks_gbp",
        "pending_change_count": "pending_count",
        "pending_valued_count": "valued_count",
        "monthly_contract_spend_gbp": "cumulative_contract_spend_gbp",
    }
    totals = {c: name for c, name in totals.items() if c in placed.columns}
    totalled = placed.select(
        "*",
        F.when(is_first, first).otherwise(month).alias("fill_from"),
        F.coalesce(following, last).alias("fill_to"),
        F.min("discount_earned_date").over(client).alias("first_discount_date"),
        *(
            F.sum(F.coalesce(F.col(c), F.lit(0))).over(so_far).alias(name)
            for c, name in totals.items()
        ),
    )
    known = []
    if of_client is not None:
        known = [c for c in of_client.columns if c != "client_id"]
        totalled = totalled.join(of_client, "client_id", "left")
    filled = totalled.select(
        "client_id",
        "first_discount_date",
        *known,
        month.alias("active_month"),
        F.explode(F.sequence("fill_from", "fill_to", F.expr("INTERVAL 1 MONTH"))).alias(
            "month_start_date"
        ),
        *flows,
        *CHANGES,
        *totals.values(),
    )
    active = F.col("active_month") == month
    before = month < F.col("active_month")  # months before a client's first activity
    return filled.select(
        "client_id",
        "month_start_date",
        F.last_day("month_start_date").alias("month_end_date"),
        "first_discount_date",
        *known,
        *(F.coalesce(F.when(active, F.col(c)), F.lit(0)).alias(c) for c in [*flows, *CHANGES]),
        *(F.when(before, 0).otherwise(F.col(name)).alias(name) for name in totals.values()),
    )


def pending_at_month_end(fct: DataFrame, dates: DataFrame) -> DataFrame:
    """Gross amount of the chargebacks that had happened by a month's end and were not
    resolved by then, for the client-months that have any."""
    activity = cut(
        monthly_activity(fct).select(
            "client_id",
            "month_start_date",
            *CHANGES,
            "discount_earned_date",
            "data_start_date",
            "data_end_date",
        ),
        "pending-activity",
    )
    changed = F.greatest(*(F.abs(F.col(c)) for c in CHANGES)) != 0
    return (
        _dense(activity.where(changed), dates, _coverage_of(activity), [])
        .where(F.col("pending_count") > 0)
        .withColumn(
            "pending_chargebacks_gbp",
            F.when(F.col("valued_count") > 0, F.col("pending_chargebacks_gbp")),
        )
        .select("client_id", "month_start_date", "pending_chargebacks_gbp")
    )


def client_monthly_revenue(fct: DataFrame, dates: DataFrame, windows: DataFrame) -> DataFrame:
    """The monthly mart: two revenue bases, pending exposure and contract progress for
    every client in every month the data covers. The fact is read once."""
    activity = cut(monthly_activity(fct), "monthly-activity")
    contracts = windows.select(
        "client_id", "contract_start_date", "contract_end_date", "spend_threshold"
    ).withColumn("has_contract", F.lit(True))
    coverage = _coverage_of(activity)
    rows = _dense(activity, dates, coverage, FLOWS, contracts)

    contracted = F.col("has_contract").isNotNull()
    month_end, earned = F.col("month_end_date"), F.col("first_discount_date")
    start, end = F.col("contract_start_date"), F.col("contract_end_date")
    cumulative = F.when(contracted, F.col("cumulative_contract_spend_gbp"))
    threshold = F.col("spend_threshold").cast("double")
    report = rows.withColumns(
        {
            "client_month_id": surrogate_key("client_id", "month_start_date"),
            "is_partial_month": (month_end > coverage.select("data_end_date").scalar()).cast("int"),
            "monthly_contract_spend_gbp": F.when(contracted, F.col("monthly_contract_spend_gbp")),
            "cumulative_contract_spend_gbp": cumulative,
            "pct_of_spend_threshold": F.round(
                F.try_divide(cumulative.cast("double"), threshold), 4
            ),
            "discount_earned_date": F.when(earned <= month_end, earned),
            "contract_status": F.when(start.isNull(), "no contract")
            .when(month_end < start, "not started")
            .when(month_end >= end, "ended")
            .otherwise("active"),
            "is_discount_active": F.when(start.isNull(), None)
            .when((month_end >= start) & (month_end < end) & (earned <= month_end), 1)
            .otherwise(0),
        }
    )
    return report.select(
        *(
            F.col(c).alias(c, metadata={"additivity": ADDITIVITY[c]}) if c in ADDITIVITY else c
            for c in MONTHLY
        )
    )


def naive_spend_by_month(fct: DataFrame) -> DataFrame:
    """Gross amount of every transaction in the contract window, whatever its type."""
    return _by_month(
        fct.where(F.col("is_in_contract_period") == 1),
        "transaction_date",
        F.sum("gross_amount_gbp").alias("monthly_naive_gross_spend_gbp"),
    )


def naive_threshold_comparison(monthly: DataFrame, fct: DataFrame) -> DataFrame:
    """Contract spend against the naive measure, for contracted clients by month."""
    so_far = (
        Window.partitionBy("client_id")
        .orderBy("month_start_date")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    naive = F.sum(F.coalesce("monthly_naive_gross_spend_gbp", F.lit(0))).over(so_far)
    contracted = monthly.where(F.col("contract_status") != "no contract").select(
        "client_id", "month_start_date", "spend_threshold", "cumulative_contract_spend_gbp"
    )

    def reached(spend: str) -> Column:
        return F.when(F.col(spend) >= F.col("spend_threshold"), 1).otherwise(0)

    return (
        contracted.join(naive_spend_by_month(fct), ["client_id", "month_start_date"], "left")
        .withColumn("naive_cumulative_gross_spend_gbp", naive)
        .drop("monthly_naive_gross_spend_gbp")
        .withColumn("is_threshold_reached", reached("cumulative_contract_spend_gbp"))
        .withColumn("is_naive_threshold_reached", reached("naive_cumulative_gross_spend_gbp"))
    )
