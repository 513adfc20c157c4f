"""Totals known for a published sample of the raw tables.

Runs if LEDGERLINE_SAMPLE names a folder with the five tables as CSV files.
"""

import os
from pathlib import Path

import pytest

from ledgerline.operators.spine import date_spine
from ledgerline.plans import monthly as mo, staging as st, transactions as tr
from ledgerline.quality import checks as ch, runner, suite
from ledgerline.sources import tables as so

SAMPLE = os.environ.get("LEDGERLINE_SAMPLE")
pytestmark = pytest.mark.skipif(not SAMPLE, reason="LEDGERLINE_SAMPLE is not set")


@pytest.fixture(scope="module")
def built(spark):
    def path(name):
        return str(Path(SAMPLE, f"{name}.csv"))

    inputs = tr.Inputs(
        so.read_transactions(spark, path("transactions"), "csv"),
        so.read_resolutions(spark, path("transaction_resolutions"), "csv"),
        so.read_rates(spark, path("currency_rates"), "csv"),
        so.read_contracts(spark, path("client_contracts"), "csv"),
        so.read_transaction_types(spark, path("transaction_types")),
    )
    fact = tr.fct_transactions(inputs).persist()
    dates = date_spine(spark, "2020-01-01", "2031-01-01")
    windows = tr.contract_windows(st.stage_contracts(inputs.contracts))
    return inputs, fact, mo.client_monthly_revenue(fact, dates, windows).persist(), dates


def one(df, *expressions):
    return df.selectExpr(*expressions).first()


def test_rows_and_duplicates(built):
    _, fact, monthly, _ = built
    assert fact.count() == 600 and monthly.count() == 70
    repeats = fact.where("is_duplicate_refund = 1")
    row = one(repeats, "count(*) n", "-sum(net_amount_gbp) gmv",
              "-sum(net_amount_gbp * applicable_fee_margin) revenue")
    assert (row.n, round(row.gmv), round(row.revenue)) == (7, 175166, 35033)


def test_rate_movement_between_payment_and_refund(built):
    inputs, fact, _, _ = built
    links = inputs.transactions.select("transaction_id", "linked_transaction_id")
    refunds = fact.join(links, "transaction_id").where(
        "linked_transaction_id IS NOT NULL AND is_duplicate_refund = 0 AND transaction_currency = 'USD'"
    )
    payments = fact.selectExpr("transaction_id AS linked_transaction_id", "net_amount_gbp AS paid",
                               "revenue_gbp AS earned")
    row = one(refunds.join(payments, "linked_transaction_id"),
              "sum(net_amount_gbp + paid) gmv", "sum(revenue_gbp + earned) revenue")
    assert (round(row.gmv), round(row.revenue)) == (1486, 297)


def test_contract_spend_leaves_out_reversals_of_earlier_payments(built):
    _, fact, _, _ = built
    refund = fact.where("client_id = 'C004' AND transaction_type = 'refund'"
                        " AND transaction_date = '2024-03-01'").first()  # fmt: skip
    assert (round(-refund.net_amount_gbp), refund.contract_spend_gbp) == (64580, 0)
    late = fact.where("client_id = 'C003' AND transaction_type = 'chargeback'"
                      " AND transaction_date = '2024-01-27'").first()  # fmt: skip
    assert str(late.resolution_date) == "2024-02-07"
    assert (round(-late.net_amount_gbp), late.contract_spend_gbp) == (23415, 0)


def test_pending_chargebacks(built):
    _, fact, monthly, _ = built
    row = one(fact.where("resolution_status = 'pending'"), "count(*) n",
              "count_if(datediff(date'2024-07-06', transaction_date) > 15) old",
              "max(datediff(date'2024-07-06', transaction_date)) oldest",
              "sum(if(datediff(date'2024-07-06', transaction_date) > 15, gross_amount_gbp, 0)) gbp",
              )
    assert (row.n, row.old, row.oldest, round(row.gbp)) == (17, 16, 167, 810270)
    july = monthly.where("month_start_date = '2024-07-01'")
    row = one(july, "sum(pending_chargebacks_gbp) p", "min(is_partial_month) partial",
              "sum(recognised_revenue_gbp) revenue")
    assert (float(row.p), row.partial) == (840011.91, 1) and row.revenue < 0


def test_thresholds(built):
    _, fact, monthly, _ = built
    naive = mo.naive_threshold_comparison(monthly, fact)
    assert naive.where("is_threshold_reached = 1").count() == 0
    crossed = naive.where("is_naive_threshold_reached = 1 AND month_start_date <= '2024-06-30'")
    assert {(r.client_id, str(r.month_start_date)) for r in crossed.collect()} == {
        ("C001", "2024-06-01"), ("C002", "2024-06-01")
    }


def test_every_check_passes(built):
    inputs, fact, monthly, dates = built
    listed = [
        *suite.rule_checks(), *suite.staging_checks(), *suite.step_checks(), *suite.mart_checks()
    ]
    results = runner.run_checks(listed, suite.all_tables(inputs, dates)).collect()
    assert [(r.table, r.check) for r in results if r.status != "pass"] == []
    assert {r.failures for r in results if r.check == "unique linked_transaction_id"} == {6}
    assert ch.reconcile(monthly, fact).count() == 0
    assert ch.sequence_is_daily(st.stage_rates(inputs.rates), "currency", "rate_date").count() == 0
