"""A small delivery worked out by hand, from CSV files to the monthly mart."""

import pytest

from ledgerline.operators.spine import date_spine
from ledgerline.plans import metrics as me, monthly as mo, staging as st, transactions as tr
from ledgerline.quality import checks as ch, runner, suite
from ledgerline.sources import tables as so

FILES = {
    "transactions": """transaction_id,client_id,transaction_amount,transaction_type,transaction_date,platform_fee_margin,currency,linked_transaction_id
T000001,C001,600.00,payment,2024-01-10,0.200,GBP,
T000002,C001,1000.00,payment,2024-01-20,0.200,USD,
T000003,C001,600.00,refund,2024-02-05,0.200,GBP,T000001
T000004,C001,600.00,refund,2024-02-10,0.200,GBP,T000001
T000005,C001,400.00,payment,2024-02-15,0.200,USD,
T000006,C001,100.00,chargeback,2024-02-20,0.200,GBP,
T000007,C001,50.00,chargeback,2024-02-25,0.200,GBP,
T000008,C001,200.00,payment,2024-04-02,0.200,GBP,
T000009,C002,500.00,payment,2024-01-15,0.200,GBP,
T000010,C002,70.00,fraud,2024-01-16,0.200,GBP,
T000011,C002,much,payment,2024-01-17,0.200,GBP,
""",
    "resolutions": """transaction_id,resolution_status,resolution_date
T000006,resolved,05/03/2024
T000007,pending,
""",
    "rates": """currency,rate_date,exchange_rate_to_gbp
GBP,2024-01-01,1.0
USD,2024-01-01,0.8
USD,2024-02-01,0.75
""",
    "contracts": """client_id,contract_start_date,contract_duration_months,spend_threshold,discounted_fee_margin
C001,2024-01-01,3,1000.00,0.100
""",
}


@pytest.fixture(scope="module")
def built(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("delivery")
    loaded = {}
    for name, text in FILES.items():
        (folder / f"{name}.csv").write_text(text)
        loaded[name] = getattr(so, f"load_{name}")(spark, str(folder / f"{name}.csv"), "csv")
    inputs = tr.Inputs(**{name: table.rows for name, table in loaded.items()}, types=so.transaction_types(spark))
    fact = so.write_mart(tr.fct_transactions(inputs), str(folder / "fact"))
    windows = tr.contract_windows(st.stage_contracts(inputs.contracts))
    mart = mo.client_monthly_revenue(fact, date_spine(spark, "2024-01-01", "2024-05-01"), windows)
    return loaded, inputs, fact, so.write_mart(mart, str(folder / "mart"), "month_start_date")


def test_the_broken_line_is_rejected(built):
    loaded = built[0]
    assert [r["line"][:7] for r in loaded["transactions"].rejected.collect()] == ["T000011"]
    assert all(loaded[name].rejected.count() == 0 for name in FILES if name != "transactions")


def test_transactions(built):
    names = "net_amount_gbp is_duplicate_refund contract_spend_gbp is_discount_earned applicable_fee_margin revenue_gbp"
    found = {
        r["transaction_id"]: tuple(None if r[n] is None else float(r[n]) for n in names.split())
        for r in built[2].collect()
    }
    assert found == {
        "T000001": (600, 0, 600, 0, 0.2, 120),
        "T000002": (800, 0, 800, 1, 0.1, 80),  # reaches 1400 of 1000
        "T000003": (-600, 0, -600, 1, 0.2, -120),  # at its payment's margin
        "T000004": (-600, 1, 0, 1, 0.2, 0),
        "T000005": (300, 0, 300, 1, 0.1, 30),  # the rate of February
        "T000006": (-100, 0, -100, 1, 0.1, -10),
        "T000007": (-50, 0, 0, 1, 0.1, 0),  # pending
        "T000008": (200, 0, 0, 0, 0.2, 40),  # after the contract
        "T000009": (500, 0, None, None, 0.2, 100),
        "T000010": (70, 0, None, None, 0.2, 0),
    }


def test_months(built):
    months = {
        (r["client_id"], r["month_start_date"].month): r
        for r in built[3].collect()
    }
    revenue = {k: float(r["recognised_revenue_gbp"]) for k, r in months.items()}
    assert revenue == {
        ("C001", 1): 200, ("C001", 2): -90, ("C001", 3): -10, ("C001", 4): 40,
        ("C002", 1): 100, ("C002", 2): 0, ("C002", 3): 0, ("C002", 4): 0,
    }
    pending = [float(months["C001", m]["pending_chargebacks_gbp"]) for m in (1, 2, 3, 4)]
    assert pending == [0, 150, 50, 50]
    to_date = [float(months["C001", m]["cumulative_contract_spend_gbp"]) for m in (1, 2, 3, 4)]
    assert to_date == [1400, 1100, 1000, 1000]
    status = [months["C001", m]["contract_status"] for m in (1, 2, 3, 4)]
    assert status == ["active", "active", "active", "ended"]


def test_totals_checks_and_grains(built):
    _, inputs, fact, mart = built
    assert ch.reconcile(mart, fact).count() == 0
    for grain, months in (("day", None), ("week", None), ("month", 4), ("quarter", 2), ("year", 1)):
        rows = me.metric_query(fact, ["revenue"], time_grain=grain).collect()
        assert round(sum(float(r["revenue"] or 0) for r in rows), 6) == 240
        assert months is None or len(rows) == months
    results = runner.run_checks(suite.staging_checks(known_repeat_refunds=1), suite.staged_tables(inputs))
    assert {r["status"] for r in results.collect()} <= {"pass", "warn"}
