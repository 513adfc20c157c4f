"""Transaction grain: classification, conversion, contract spend, margins and revenue."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import add_months_overflow
from ..operators.asof import asof_join, daily_lookup
from ..operators.cuts import bucketed_cut, cut
from ..operators.linked import attach_linked, linked_rows
from ..operators.running import first_crossing, in_parts, place, running_total
from ..schemas import AMOUNT, MONEY
from .staging import (
    flag_duplicate_refunds,
    stage_contracts,
    stage_rates,
    stage_resolutions,
    stage_transactions,
)

CLASSIFIED = [
    "transaction_id",
    "transaction_date",
    "client_id",
    "transaction_type",
    "transaction_currency",
    "platform_fee_margin",
    "amount_direction",
    "gross_amount_local",
    "net_amount_local",
    "resolution_status",
    "resolution_date",
    "linked_transaction_id",
    "linked_payment_date",
    "is_duplicate_refund",
    "spend_effective_date",
    "is_revenue_recognised",
    "is_spend_qualifying",
]
CONVERTED = [*CLASSIFIED, "gross_amount_gbp", "net_amount_gbp"]
WITH_SPEND = [
    *(c for c in CONVERTED if c != "linked_payment_date"),
    "discounted_fee_margin",
    "is_in_contract_period",
    "contract_spend_gbp",
    "running_contract_spend_gbp",
    "is_discount_earned",
]
FACT = [
    "transaction_id",
    "client_id",
    "transaction_type",
    "transaction_currency",
    "transaction_date",
    "resolution_status",
    "resolution_date",
    "recognition_date",
    "spend_effective_date",
    "amount_direction",
    "gross_amount_local",
    "net_amount_local",
    "gross_amount_gbp",
    "net_amount_gbp",
    "is_duplicate_refund",
    "is_revenue_recognised",
    "is_spend_qualifying",
    "is_in_contract_period",
    "contract_spend_gbp",
    "is_discount_earned",
    "applicable_fee_margin",
    "revenue_gbp",
]


#: The number that a written row keeps while its totals are computed.
ROW = "_row"
LINK = {"row_id": "transaction_id", "link": "linked_transaction_id"}
LEDGER = {
    "key": "client_id",
    "day": "spend_effective_date",
    "row_id": "transaction_id",
    "value": "contract_spend_gbp",
}


@dataclass(frozen=True)
class Inputs:
    """The raw tables and the rule table."""

    transactions: DataFrame
    resolutions: DataFrame
    rates: DataFrame
    contracts: DataFrame
    types: DataFrame


def linked_payments(
    transactions: DataFrame, resolutions: DataFrame, links: DataFrame | None = None
) -> DataFrame:
    """What a refund needs to know of the payment it reverses, one row per linked
    transaction. All joins are on the transaction id. ``links`` are the links of all, if a slim
    table has them."""
    dated = linked_rows(
        transactions if links is None else links,
        transactions.select(
            "transaction_id", "transaction_date", "client_id", "platform_fee_margin"
        ),
        **LINK,
    ).join(
        resolutions.select("transaction_id", "resolution_date").hint("merge"), "transaction_id", "left"
    )
    return dated.withColumn(
        "spend_effective_date", F.coalesce("resolution_date", "transaction_date")
    ).drop("resolution_date")


def classify(
    transactions: DataFrame,
    resolutions: DataFrame,
    types: DataFrame,
    payments: DataFrame | None = None,
    links: DataFrame | None = None,
) -> DataFrame:
    """Apply the behaviour of each transaction's type: sign, settlement, eligibility.

    Resolutions, duplicate flags and linked payments are all looked up by transaction
    id, so the transactions are shuffled once.
    """
    if payments is None:
        payments = cut(linked_payments(transactions, resolutions, links), "linked-payments")
    rows = attach_linked(
        transactions.join(resolutions.hint("merge"), "transaction_id", "left"),
        payments,
        names={"transaction_date": "linked_payment_date"},
        links=links,
        **LINK,
    ).join(types, "transaction_type", "left")  # a file or inline table, so Spark knows it is small

    settled = (
        F.when(F.col("requires_resolution") == 0, 1)
        .when(F.col("resolution_status") == "resolved", 1)
        .otherwise(0)
    )
    # products, not AND: an unknown type has no rule and stays NULL
    is_duplicate = F.col("is_duplicate_refund") == 1
    net = F.col("transaction_amount") * F.col("amount_direction")
    return rows.withColumns(
        {
            "gross_amount_local": F.col("transaction_amount"),
            "net_amount_local": net.cast(AMOUNT),
            "spend_effective_date": F.coalesce("resolution_date", "transaction_date"),
            "is_revenue_recognised": F.when(is_duplicate, 0).otherwise(
                F.col("recognises_revenue") * settled
            ),
            "is_spend_qualifying": F.when(is_duplicate, 0).otherwise(
                F.col("counts_toward_spend") * settled
            ),
        }
    ).select(*CLASSIFIED)


def daily_rates(rates: DataFrame) -> DataFrame:
    return daily_lookup(rates, "currency", "rate_date", "exchange_rate_to_gbp")


def convert_to_gbp(classified: DataFrame, daily: DataFrame) -> DataFrame:
    """Add amounts at the latest rate on or before the transaction date, which also
    holds for refunds and for chargebacks that resolve later."""
    rated = asof_join(
        classified,
        daily,
        key=("transaction_currency", "currency"),
        day=("transaction_date", "rate_date"),
        value="exchange_rate_to_gbp",
    )
    rate = F.col("exchange_rate_to_gbp")
    return rated.select(
        *classified.columns,
        F.round(F.col("gross_amount_local") * rate, 2).cast(MONEY).alias("gross_amount_gbp"),
        F.round(F.col("net_amount_local") * rate, 2).cast(MONEY).alias("net_amount_gbp"),
    )


def contract_windows(contracts: DataFrame, clamp: bool = False) -> DataFrame:
    """Add the exclusive end date: the start date plus the contract's months."""
    end = add_months_overflow(
        F.col("contract_start_date"), F.col("contract_duration_months"), clamp
    )
    return contracts.withColumn("contract_end_date", end)


def _in_window(day: str) -> Column:
    """NULL without a contract, as a contract's dates then are."""
    return (F.col(day) >= F.col("contract_start_date")) & (F.col(day) < F.col("contract_end_date"))


def _discount_earned(in_period: Column) -> Column:
    """Whether the row stands at or after the one that reached the threshold; NULL as
    long as the client's running spend has no value."""
    here = place(F.col("spend_effective_date"), F.col("transaction_id"))
    return (
        F.when(~in_period, 0)
        .when(in_period.isNull(), None)
        .when(here >= F.col("crossing"), 1)
        .when(here >= F.col("first_value"), 0)
    )


def _own_margin(in_period: Column, earned: Column) -> Column:
    discounted = in_period & (earned == 1)
    return F.when(discounted, F.col("discounted_fee_margin")).otherwise(
        F.col("platform_fee_margin")
    )


def apply_windows(converted: DataFrame, windows: DataFrame) -> DataFrame:
    """Join the client's contract and add what the transaction adds to contract spend.

    Reversals count only if what they reverse counted and if they take effect inside the
    window. Clients without a contract get NULL.
    """
    in_period = _in_window("transaction_date")
    counts = (
        in_period
        & _in_window("spend_effective_date")
        & (F.col("is_spend_qualifying") == 1)
        & F.coalesce(_in_window("linked_payment_date"), F.lit(True))
    )
    spend = F.when(
        in_period.isNotNull(), F.when(counts, F.col("net_amount_gbp")).otherwise(F.lit(0))
    )
    return (
        converted.join(windows, "client_id", "left")
        .withColumn("is_in_contract_period", in_period.cast("int"))
        .withColumn("contract_spend_gbp", spend.cast(MONEY))
    )


def spend_ledger(converted: DataFrame, windows: DataFrame) -> DataFrame:
    """The rows of contracted clients, cut to what a running total needs and written in parts of its
    order."""
    rows = (
        apply_windows(converted, windows.withColumn("has_contract", F.lit(True)))
        .where(F.col("has_contract"))
        .where(F.col("spend_effective_date").isNotNull())
        .select(
            "client_id",
            "spend_effective_date",
            "transaction_id",
            "contract_spend_gbp",
            "spend_threshold",
            *(c for c in [ROW] if c in converted.columns),
        )
    )
    return in_parts(rows, **{k: v for k, v in LEDGER.items() if k != "value"})


def contract_terms(windows: DataFrame, ledger: DataFrame) -> DataFrame:
    """The contracts with the place at which each client's running spend first reaches
    its threshold. Spend that falls again later does not take the discount back, so
    this place alone tells which transactions have it."""
    reached = first_crossing(ledger, threshold="spend_threshold", **LEDGER)
    return windows.join(reached, "client_id", "left")


def apply_terms(converted: DataFrame, terms: DataFrame) -> DataFrame:
    """``apply_windows`` plus whether the discount has been earned."""
    in_period = F.col("is_in_contract_period") == 1
    return apply_windows(converted, terms).withColumn(
        "is_discount_earned", _discount_earned(in_period)
    )


def numbered(converted: DataFrame) -> DataFrame:
    """The rows with a number each, which holds once they are written."""
    return converted.withColumn(ROW, F.monotonically_increasing_id())


def contract_spend(converted: DataFrame, windows: DataFrame) -> DataFrame:
    """Contract spend of each transaction, its client's running spend up to it in the
    order transactions take effect, and whether the discount has been earned.

    The rows are written once with a number each, unless they were already, by which their running totals, made of
    the slim ledger of contracted rows, come back: ids may repeat or be NULL.
    """
    rows = converted if ROW in converted.columns else cut(numbered(converted), "converted-rows")
    ledger = spend_ledger(rows, windows)
    terms = cut(contract_terms(windows, ledger), "contract-terms")
    running = running_total(ledger, out="running_contract_spend_gbp", **LEDGER)
    totals = running.select(ROW, "running_contract_spend_gbp")
    return apply_terms(rows, terms).join(totals, ROW, "left").select(*WITH_SPEND)


def price_revenue(with_spend: DataFrame) -> DataFrame:
    """Pick the fee margin and the recognition date and compute revenue.

    A refund reverses revenue at its payment's own margin. If ``with_spend`` does not
    bring that margin as ``linked_fee_margin``, it is looked up among its rows.
    """
    own = with_spend.withColumn(
        "own_fee_margin", _own_margin(F.col("is_in_contract_period") == 1, F.col("is_discount_earned"))
    )
    if "linked_fee_margin" not in own.columns:
        margins = cut(
            linked_rows(own, own.select("transaction_id", "own_fee_margin"), **LINK),
            "linked-margins",
        )
        own = attach_linked(own, margins, names={"own_fee_margin": "linked_fee_margin"}, **LINK)
    recognised = F.col("is_revenue_recognised")
    priced = own.withColumns(
        {
            "recognition_date": F.when(recognised == 1, F.col("spend_effective_date")),
            "applicable_fee_margin": F.coalesce("linked_fee_margin", "own_fee_margin"),
        }
    )
    revenue = F.col("net_amount_gbp") * F.col("applicable_fee_margin")
    return priced.withColumn("revenue_gbp", F.when(recognised == 0, 0).otherwise(revenue)).select(
        *FACT
    )


def fct_transactions(inputs: Inputs) -> DataFrame:
    """The transaction fact from the raw tables.

    Equal to ``price_revenue(contract_spend(...))``, without the running total of every row. The raw
    transactions are read three times: for the links, for the rows linked to, and for
    classified, converted rows. These are written once, in buckets by id: the ledger reads
    them, and the margins of linked payments meet them without another shuffle.
    """
    transactions = stage_transactions(inputs.transactions)
    resolutions = stage_resolutions(inputs.resolutions)
    windows = contract_windows(stage_contracts(inputs.contracts))
    is_refund = F.col("transaction_type") == "refund"
    links = cut(
        transactions.where(F.col("linked_transaction_id").isNotNull() | is_refund).select(
            "transaction_id", "linked_transaction_id", "transaction_type", "transaction_date"
        ),
        "links",
    )
    payments = cut(linked_payments(transactions, resolutions, links), "linked-payments")
    flagged = flag_duplicate_refunds(transactions, among=links)
    classified = classify(flagged, resolutions, inputs.types, payments, links)
    rows = bucketed_cut(
        convert_to_gbp(classified, daily_rates(stage_rates(inputs.rates))),
        "converted",
        ["transaction_id"],
        int(transactions.sparkSession.conf.get("spark.sql.shuffle.partitions")),
    )
    terms = cut(contract_terms(windows, spend_ledger(rows, windows)), "contract-terms")
    in_period = _in_window("transaction_date")
    margins = payments.join(terms, "client_id", "left").select(
        "transaction_id",
        _own_margin(in_period, _discount_earned(in_period)).alias("own_fee_margin"),
    )
    names = {"own_fee_margin": "linked_fee_margin"}
    priced = attach_linked(rows, cut(margins, "linked-margins"), names=names, links=links, **LINK)
    return price_revenue(apply_terms(priced, terms))
