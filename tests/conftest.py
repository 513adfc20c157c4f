from __future__ import annotations

import datetime as dt
import sys
from decimal import Decimal
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from ledgerline import schemas  # noqa: E402
from ledgerline.session import local_session  # noqa: E402

TESTDATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session(
        4, partitions=4, **{"spark.checkpoint.dir": str(tmp_path_factory.mktemp("scratch"))}
    )
    yield session
    session.stop()


def day(text: str | None) -> dt.date | None:
    return None if text is None else dt.date.fromisoformat(text)


def frame(spark, schema: str, rows: list[dict]):
    """Rows from dicts; columns not given are NULL, dates are ISO text, numbers exact."""
    from pyspark.sql import types as T

    struct = T.StructType.fromDDL(schema)

    def value(field, raw):
        if raw is None:
            return None
        if isinstance(field.dataType, T.DateType):
            return day(raw)
        if isinstance(field.dataType, T.DecimalType):
            return Decimal(str(raw))
        return raw

    data = [tuple(value(f, row.get(f.name)) for f in struct.fields) for row in rows]
    return spark.createDataFrame(data, struct)


CONVERTED = """
    transaction_id string, transaction_date date, client_id string, transaction_type string,
    transaction_currency string, platform_fee_margin decimal(4,3), amount_direction int,
    gross_amount_local decimal(14,2), net_amount_local decimal(14,2), resolution_status string,
    resolution_date date, linked_transaction_id string, linked_payment_date date,
    is_duplicate_refund int, spend_effective_date date, is_revenue_recognised int,
    is_spend_qualifying int, gross_amount_gbp decimal(18,2), net_amount_gbp decimal(18,2)"""

WINDOWS = """
    client_id string, contract_start_date date, contract_end_date date,
    spend_threshold decimal(14,2), discounted_fee_margin decimal(4,3)"""

FACT = """
    transaction_id string, client_id string, transaction_type string, transaction_currency string,
    transaction_date date, resolution_status string, resolution_date date, recognition_date date,
    spend_effective_date date, amount_direction int, gross_amount_gbp decimal(18,2),
    net_amount_gbp decimal(18,2), is_duplicate_refund int, is_revenue_recognised int,
    is_in_contract_period int, contract_spend_gbp decimal(18,2), is_discount_earned int,
    revenue_gbp decimal(23,5)"""


def columns(df, *names: str, key: str = "transaction_id") -> dict:
    """Values of the named columns by key, decimals as floats."""

    def plain(value):
        return float(value) if isinstance(value, Decimal) else value

    return {row[key]: tuple(plain(row[n]) for n in names) for row in df.collect()}


def raw_transactions(spark, rows: list[dict]):
    ddl = ", ".join(
        f"{f.name} {f.dataType.simpleString()}" for f in schemas.TRANSACTIONS.fields
    )
    return frame(spark, ddl, rows)
