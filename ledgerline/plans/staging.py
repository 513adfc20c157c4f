"""Typed inputs: one function per raw table, each a projection without a shuffle."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions import iso_date, slashed_date, surrogate_key
from ..operators.linked import flag_later_in_group
from ..schemas import AMOUNT, MARGIN, RATE


def stage_transactions(raw: DataFrame) -> DataFrame:
    return raw.select(
        F.col("transaction_id").cast("string"),
        F.col("client_id").cast("string"),
        F.col("transaction_amount").try_cast(AMOUNT).alias("transaction_amount"),
        F.col("transaction_type").cast("string"),
        F.col("platform_fee_margin").try_cast(MARGIN).alias("platform_fee_margin"),
        F.col("currency").cast("string").alias("transaction_currency"),
        F.col("linked_transaction_id").cast("string"),
        iso_date(F.col("transaction_date")).alias("transaction_date"),
    )


def flag_duplicate_refunds(
    transactions: DataFrame, among: DataFrame | None = None
) -> DataFrame:
    """Add ``is_duplicate_refund``: 1 on every refund of a payment but its first one, by
    date and then id, one of them where copies share that place. Refunds are always in full, so a second one cannot
    be genuine. No row is dropped. ``among`` are the refunds of all transactions, if a slim table has them."""
    return flag_later_in_group(
        transactions,
        group="linked_transaction_id",
        order=["transaction_date"],
        row_id="transaction_id",
        where=F.col("transaction_type") == "refund",
        flag="is_duplicate_refund",
        among=among,
    )


def stage_resolutions(raw: DataFrame) -> DataFrame:
    return raw.select(
        F.col("transaction_id").cast("string"),
        F.col("resolution_status").cast("string"),
        slashed_date(F.col("resolution_date")).alias("resolution_date"),
    )


def stage_rates(raw: DataFrame) -> DataFrame:
    typed = raw.select(
        F.col("currency").cast("string"),
        iso_date(F.col("rate_date")).alias("rate_date"),
        F.col("exchange_rate_to_gbp").try_cast(RATE).alias("exchange_rate_to_gbp"),
    )
    return typed.select(surrogate_key("currency", "rate_date").alias("currency_rate_id"), "*")


def stage_contracts(raw: DataFrame) -> DataFrame:
    return raw.select(
        F.col("client_id").cast("string"),
        F.col("contract_duration_months").try_cast("int").alias("contract_duration_months"),
        F.col("spend_threshold").try_cast(AMOUNT).alias("spend_threshold"),
        F.col("discounted_fee_margin").try_cast(MARGIN).alias("discounted_fee_margin"),
        iso_date(F.col("contract_start_date")).alias("contract_start_date"),
    )
