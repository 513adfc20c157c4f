"""Schemas of the five input tables, money types and additivity of the monthly mart."""

from __future__ import annotations

from pyspark.sql import types as T

AMOUNT = T.DecimalType(14, 2)
MONEY = T.DecimalType(18, 2)
MARGIN = T.DecimalType(10, 8)
#: Wide enough for a yen in pounds; amounts are rounded only once converted.
RATE = T.DecimalType(18, 10)


def _schema(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields])


# As delivered: dates stay text, because resolution dates come as dd/mm/yyyy and
# malformed dates have to reach staging, which turns them into NULL.
TRANSACTIONS = _schema(
    ("transaction_id", T.StringType()),
    ("client_id", T.StringType()),
    ("transaction_amount", AMOUNT),
    ("transaction_type", T.StringType()),
    ("transaction_date", T.StringType()),
    ("platform_fee_margin", MARGIN),
    ("currency", T.StringType()),
    ("linked_transaction_id", T.StringType()),
)
RESOLUTIONS = _schema(
    ("transaction_id", T.StringType()),
    ("resolution_status", T.StringType()),
    ("resolution_date", T.StringType()),
)
RATES = _schema(
    ("currency", T.StringType()),
    ("rate_date", T.StringType()),
    ("exchange_rate_to_gbp", RATE),
)
CONTRACTS = _schema(
    ("client_id", T.StringType()),
    ("contract_start_date", T.StringType()),
    ("contract_duration_months", T.IntegerType()),
    ("spend_threshold", AMOUNT),
    ("discounted_fee_margin", MARGIN),
)
TRANSACTION_TYPES = _schema(
    ("transaction_type", T.StringType()),
    ("amount_direction", T.IntegerType()),
    ("recognises_revenue", T.IntegerType()),
    ("counts_toward_spend", T.IntegerType()),
    ("requires_resolution", T.IntegerType()),
)

# How each transaction type behaves, in the column order above.
TRANSACTION_TYPE_RULES = [
    ("payment", 1, 1, 1, 0),
    ("refund", -1, 1, 1, 0),
    ("chargeback", -1, 1, 1, 1),
    ("fraud", 1, 0, 0, 0),
]

# How the measures of the monthly mart may be summed. Additive ones
# sum over anything, semi-additive ones over clients only, the others never.
ADDITIVITY = {
    "recognised_gross_gmv_gbp": "additive",
    "recognised_net_gmv_gbp": "additive",
    "recognised_revenue_gbp": "additive",
    "recognised_transaction_count": "additive",
    "originated_net_gmv_gbp": "additive",
    "originated_revenue_gbp": "additive",
    "monthly_contract_spend_gbp": "additive",
    "pending_chargebacks_gbp": "semi_additive",
    "cumulative_contract_spend_gbp": "semi_additive",
    "spend_threshold": "non_additive",
    "pct_of_spend_threshold": "non_additive",
}
