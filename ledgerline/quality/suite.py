"""The checks of every table, from the raw rules to the monthly mart."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..operators.cuts import cut
from ..plans import monthly as mo, staging as st, transactions as tr
from .runner import Check

FLAG = [0, 1]
NO_CONTRACT = "no contract"


def not_null(table: str, *columns: str, where: str | None = None) -> list[Check]:
    return [Check(table, "not_null", column, where=where) for column in columns]


def key(table: str, column: str) -> list[Check]:
    return [Check(table, "unique", column), *not_null(table, column)]


def values(table: str, column: str, accepted: list) -> Check:
    return Check(table, "accepted_values", column, {"values": accepted})


def flag(table: str, column: str) -> list[Check]:
    return [*not_null(table, column), values(table, column, FLAG)]


def is_true(table: str, column: str, expression: str, where: str | None = None) -> Check:
    return Check(table, "expression_is_true", column, {"expression": expression}, where)


def in_range(table: str, column: str, low, high=None, inclusive=True, **options) -> Check:
    bounds = {"min_value": low, "max_value": high, "inclusive": inclusive}
    return Check(table, "accepted_range", column, bounds, **options)


def related(
    table: str,
    column: str,
    parent: str,
    field: str,
    where: str | None = None,
    parent_where: str | None = None,
) -> Check:
    arguments = {"parent": parent, "field": field}
    if parent_where is not None:
        arguments["parent_where"] = parent_where
    return Check(table, "relationships", column, arguments, where)


def same_size(table: str, other: str) -> Check:
    return Check(table, "equal_rowcount", arguments={"other": other})


def rule_checks() -> list[Check]:
    table = "transaction_types"
    return [
        *key(table, "transaction_type"),
        *not_null(table, "amount_direction"),
        values(table, "amount_direction", [1, -1]),
        *flag(table, "recognises_revenue"),
        *flag(table, "counts_toward_spend"),
        *flag(table, "requires_resolution"),
    ]


def staging_checks(
    client_pattern: str = "^C[0-9]{3}$",
    transaction_pattern: str = "^T[0-9]{6}$",
    known_repeat_refunds: int = 6,
) -> list[Check]:
    """``known_repeat_refunds`` payments refunded more than once are tolerated."""
    client_format = f"RLIKE '{client_pattern}'"
    t, r, x, c = "transactions", "resolutions", "rates", "contracts"
    return [
        # contracts: there is no list of clients to check ids against, only their format
        *key(c, "client_id"),
        is_true(c, "client_id", client_format),
        *not_null(c, "contract_start_date", "contract_duration_months", "spend_threshold"),
        in_range(c, "contract_duration_months", 0, inclusive=False),
        in_range(c, "spend_threshold", 0, inclusive=False),
        *not_null(c, "discounted_fee_margin"),
        in_range(c, "discounted_fee_margin", 0, 1),
        in_range(c, "discounted_fee_margin", 0.1, 0.2, inclusive=False, severity="warn"),
        # rates
        *key(x, "currency_rate_id"),
        *not_null(x, "currency", "rate_date", "exchange_rate_to_gbp"),
        is_true(x, "currency", "RLIKE '^[A-Z]{3}$'"),
        in_range(x, "exchange_rate_to_gbp", 0, inclusive=False),
        in_range(x, "exchange_rate_to_gbp", 1, 1, where="currency = 'GBP'"),
        # transactions
        *key(t, "transaction_id"),
        is_true(t, "transaction_id", f"RLIKE '{transaction_pattern}'"),
        related(t, "transaction_id", r, "transaction_id", "transaction_type = 'chargeback'"),
        *not_null(t, "client_id", "transaction_amount", "transaction_type", "transaction_date"),
        is_true(t, "client_id", client_format),
        is_true(t, "transaction_amount", "> 0"),
        related(t, "transaction_type", "transaction_types", "transaction_type"),
        *not_null(t, "platform_fee_margin"),
        in_range(t, "platform_fee_margin", 0, 1),
        in_range(t, "platform_fee_margin", 0.1, 0.3, severity="warn"),
        *not_null(t, "transaction_currency"),
        related(t, "transaction_currency", x, "currency"),
        *not_null(t, "linked_transaction_id", where="transaction_type = 'refund'"),
        is_true(t, "linked_transaction_id", "IS NULL", "transaction_type != 'refund'"),
        related(
            t, "linked_transaction_id", t, "transaction_id",
            parent_where="transaction_type = 'payment'",
        ),
        Check(
            t, "unique", "linked_transaction_id", warn_above=known_repeat_refunds,
            error_above=known_repeat_refunds, store_failures=True,
        ),
        *flag(t, "is_duplicate_refund"),
        is_true(t, "is_duplicate_refund", "= 0", "transaction_type != 'refund'"),
        # resolutions
        *key(r, "transaction_id"),
        related(
            r, "transaction_id", t, "transaction_id",
            parent_where="transaction_type = 'chargeback'",
        ),
        *not_null(r, "resolution_status"),
        values(r, "resolution_status", ["resolved", "pending"]),
        *not_null(r, "resolution_date", where="resolution_status = 'resolved'"),
        is_true(r, "resolution_date", "IS NULL", "resolution_status = 'pending'"),
    ]


def step_checks() -> list[Check]:
    """The steps between staging and marts. Equal row counts catch joins that fan out."""
    w, a, b, s, v = "contract_windows", "classified", "converted", "contract_spend", "revenue"
    contracted = "is_in_contract_period IS NOT NULL"
    return [
        *key(w, "client_id"),
        *not_null(w, "contract_end_date"),
        is_true(w, "contract_end_date", "> contract_start_date"),
        same_size(a, "transactions"),
        *key(a, "transaction_id"),
        *not_null(a, "net_amount_local", "spend_effective_date"),
        *not_null(a, "linked_payment_date", where="transaction_type = 'refund'"),
        *flag(a, "is_revenue_recognised"),
        *flag(a, "is_spend_qualifying"),
        same_size(b, a),
        *key(b, "transaction_id"),
        *not_null(b, "gross_amount_gbp", "net_amount_gbp"),
        is_true(b, "net_amount_gbp", "< 0", "amount_direction = -1"),
        is_true(b, "net_amount_gbp", "> 0", "amount_direction = 1"),
        same_size(s, b),
        *key(s, "transaction_id"),
        *not_null(
            s, "discounted_fee_margin", "contract_spend_gbp", "running_contract_spend_gbp",
            where=contracted,
        ),
        values(s, "is_in_contract_period", FLAG),
        values(s, "is_discount_earned", FLAG),
        same_size(v, s),
        *key(v, "transaction_id"),
        *not_null(v, "applicable_fee_margin", "revenue_gbp"),
        in_range(v, "applicable_fee_margin", 0, 1),
        *not_null(v, "recognition_date", where="is_revenue_recognised = 1"),
        is_true(v, "recognition_date", "IS NULL", "is_revenue_recognised = 0"),
        is_true(v, "revenue_gbp", "<= 0", "amount_direction = -1"),
        is_true(v, "revenue_gbp", ">= 0", "amount_direction = 1"),
    ]


def mart_checks() -> list[Check]:
    d, f, m = "dates", "fct_transactions", "monthly"
    contracted = f"contract_status != '{NO_CONTRACT}'"
    return [
        *key(d, "date_day"),
        *not_null(d, "month_start_date", "month_end_date"),
        same_size(f, "revenue"),
        *key(f, "transaction_id"),
        related(f, "transaction_date", d, "date_day"),
        related(f, "recognition_date", d, "date_day"),
        *key(m, "client_month_id"),
        related(m, "month_start_date", d, "month_start_date"),
        *flag(m, "is_partial_month"),
        *not_null(
            m, "recognised_gross_gmv_gbp", "recognised_net_gmv_gbp", "recognised_revenue_gbp",
            "recognised_transaction_count", "originated_net_gmv_gbp", "originated_revenue_gbp",
            "pending_chargebacks_gbp", "contract_status",
        ),
        values(m, "contract_status", [NO_CONTRACT, "not started", "active", "ended"]),
        *not_null(
            m, "monthly_contract_spend_gbp", "cumulative_contract_spend_gbp",
            "pct_of_spend_threshold", "is_discount_active", where=contracted,
        ),
        values(m, "is_discount_active", FLAG),
    ]


def staged_tables(inputs: tr.Inputs) -> dict[str, DataFrame]:
    return {
        "transaction_types": inputs.types,
        "transactions": cut(
            st.flag_duplicate_refunds(st.stage_transactions(inputs.transactions)), "staged"
        ),
        "resolutions": st.stage_resolutions(inputs.resolutions),
        "rates": st.stage_rates(inputs.rates),
        "contracts": st.stage_contracts(inputs.contracts),
    }


def all_tables(inputs: tr.Inputs, dates: DataFrame) -> dict[str, DataFrame]:
    """Every table from staging to the marts, written where a later step reads it. Rows of the monthly mart, many
    times those of all others, go to the checks as they are made; only its activity is written."""
    tables = staged_tables(inputs)
    windows = cut(tr.contract_windows(tables["contracts"]), "windows")
    classified = cut(
        tr.classify(tables["transactions"], tables["resolutions"], inputs.types), "classified"
    )
    converted = cut(
        tr.numbered(tr.convert_to_gbp(classified, tr.daily_rates(tables["rates"]))), "converted"
    )
    spend = cut(tr.contract_spend(converted, windows), "contract-spend")
    revenue = cut(tr.price_revenue(spend), "revenue")
    return tables | {
        "contract_windows": windows,
        "classified": classified,
        "converted": converted.drop(tr.ROW),
        "contract_spend": spend,
        "revenue": revenue,
        "fct_transactions": revenue,
        "dates": dates,
        "monthly": mo.client_monthly_revenue(revenue, dates, windows),
    }
