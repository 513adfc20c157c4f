"""Shapes of the physical plans, which is what has to hold at scale."""

import re

import pytest

from conftest import TESTDATA, raw_transactions
from ledgerline.operators import cuts, linked, running
from ledgerline.operators.running import running_total
from ledgerline.operators.spine import date_spine
from ledgerline.plans import metrics as me, monthly as mo, staging as st, transactions as tr
from ledgerline.quality import checks as ch, runner
from ledgerline.sources.bridge import bridge, land

PYTHON = re.compile("EvalPython|InPandas|InArrow|PythonUDF")


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def final_plan(df) -> str:
    """The plan after AQE; running it is what makes it final."""
    execution = df._jdf.queryExecution()
    execution.toRdd().count()
    return execution.executedPlan().toString().split("== Initial")[0]


class Conf:
    def __init__(self, spark, **values):
        self.spark, self.values = spark, {f"spark.sql.{k}": v for k, v in values.items()}

    def __enter__(self):
        for name, value in self.values.items():
            self.spark.conf.set(name, value)

    def __exit__(self, *_):
        for name in self.values:
            self.spark.conf.unset(name)


@pytest.fixture(scope="module")
def inputs(spark):
    return land(bridge(spark, TESTDATA))


@pytest.fixture(scope="module")
def fact(inputs):
    return cuts.cut(tr.fct_transactions(inputs), "fact")


def test_everything_stays_in_the_jvm(spark, inputs, fact):
    dates = date_spine(spark, "1995-01-01", "2003-01-01")
    windows = tr.contract_windows(st.stage_contracts(inputs.contracts))
    monthly = mo.client_monthly_revenue(fact, dates, windows)
    for df in [
        tr.fct_transactions(inputs), monthly, mo.naive_threshold_comparison(monthly, fact),
        me.metric_query(fact, list(me.METRICS), time_grain="month"), ch.reconcile(monthly, fact),
    ]:
        assert not PYTHON.search(plan(df))
        assert "CartesianProduct" not in plan(df)


def test_transactions_are_shuffled_once_by_id(spark, inputs):
    """Duplicates, resolutions and linked payments are three joins on one exchange."""
    transactions = st.stage_transactions(inputs.transactions)
    resolutions = st.stage_resolutions(inputs.resolutions)
    with Conf(spark, autoBroadcastJoinThreshold="-1"):
        payments = cuts.cut(tr.linked_payments(transactions, resolutions), "payments")
        text = plan(
            tr.classify(st.flag_duplicate_refunds(transactions), resolutions, inputs.types, payments)
        )
    assert len(re.findall(r"SortMergeJoin \[transaction_id", text)) == 3
    # transactions, resolutions, first refunds, linked payments by their own id and by their refund's
    assert len(re.findall(r"Exchange hashpartitioning\((?:transaction)?_id#\d+, 4\)", text)) == 5


def test_raw_transactions_are_read_three_times(spark, inputs, monkeypatch):
    """Counted in the plans of all tables that the fact writes, and its own."""
    path = inputs.transactions.inputFiles()[0].rsplit("/", 1)[0]
    plans: list[str] = []

    def seen(df, *rest):
        plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        files = [line for line in df._jdf.queryExecution().executedPlan().toString().split("\n") if "FileScan" in line]
        scans.append(sum(path.rsplit("/", 1)[1][:20] in line for line in files))

    scans: list[int] = []
    with Conf(spark, maxMetadataStringLength="1000"):
        for module in (tr, linked, running):
            for name in ("cut", "bucketed_cut"):
                if hasattr(module, name):
                    original = getattr(module, name)

                    def wrapped(df, *rest, original=original):
                        seen(df)
                        return original(df, *rest)

                    monkeypatch.setattr(module, name, wrapped)
        seen(tr.fct_transactions(inputs))
    assert sum(scans) == 3


def test_written_rows_meet_linked_margins_without_a_shuffle(spark, inputs):
    with Conf(spark, autoBroadcastJoinThreshold="-1"):
        text = plan(tr.fct_transactions(inputs))
    assert "Bucketed: true" in text or "SelectedBucketsCount" in text
    # the answers by link and by id; the rows themselves stay in their buckets
    wide = [line for line in text.split("\n") if "Exchange" in line and "transaction_id" in line]
    assert len(re.findall(r"SortMergeJoin \[transaction_id", text)) == 1 and len(wide) <= 3


def test_rates_and_contracts_do_not_shuffle_transactions(inputs):
    transactions = st.flag_duplicate_refunds(st.stage_transactions(inputs.transactions))
    rows = tr.classify(transactions, st.stage_resolutions(inputs.resolutions), inputs.types)
    text = plan(tr.convert_to_gbp(rows, tr.daily_rates(st.stage_rates(inputs.rates))))
    assert re.search(r"BroadcastHashJoin \[transaction_currency#\d+, _probe", text)
    for each in (text, plan(tr.fct_transactions(inputs))):
        assert "hashpartitioning(client_id" not in each and "hashpartitioning(transaction_currency" not in each


def test_no_window_takes_all_rows_of_a_client(spark, inputs):
    """Windows over transactions are by client and part; those by client alone run over sums by
    part."""
    tx = st.flag_duplicate_refunds(st.stage_transactions(inputs.transactions))
    rows = tr.classify(tx, st.stage_resolutions(inputs.resolutions), inputs.types)
    rows = tr.convert_to_gbp(rows, tr.daily_rates(st.stage_rates(inputs.rates)))
    windows = tr.contract_windows(st.stage_contracts(inputs.contracts))
    ledger = tr.spend_ledger(rows, windows)
    running = running_total(ledger, out="total", **tr.LEDGER)
    text = plan(running) + plan(tr.contract_terms(windows, ledger))
    specs = re.findall(r"windowspecdefinition\((.*?), specifiedwindowframe", text)
    assert specs
    for spec in specs:
        columns = re.sub(r"#\d+L?", "", spec)
        if "transaction_id" in columns:
            assert columns.startswith("client_id, _part")


def test_reports_read_only_their_columns(spark, fact):
    text = plan(mo.recognised_by_month(fact))
    schema = re.search(r"ReadSchema: struct<([^>]*)", text)[1]
    assert {c.split(":")[0] for c in schema.split(",") if ":" in c} <= {
        "client_id", "recognition_date", "amount_direction", "gross_amount_gbp", "net_amount_gbp",
        "is_revenue_recognised", "revenue_gbp",
    }
    assert "EqualTo(is_revenue_recognised,1)" in text
    assert text.count("Exchange") == 1
    assert plan(me.metric_query(fact, list(me.METRICS), time_grain="month")).count("Exchange") == 1


SMALL = {
    "adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
    "adaptive.skewJoin.skewedPartitionFactor": "2",
    "adaptive.coalescePartitions.enabled": "false",  # a partition is split by its mappers
    "adaptive.advisoryPartitionSizeInBytes": "10KB",
    "autoBroadcastJoinThreshold": "-1",
}


def test_a_hot_link_is_split(spark):
    """Half of all refunds reverse one payment."""
    rows = [{"transaction_id": "T0", "transaction_type": "payment", "transaction_date": "2024-01-01"}]
    rows += [
        {"transaction_id": f"T{i}", "transaction_type": "refund", "transaction_date": "2024-01-02",
         "linked_transaction_id": "T0" if i % 2 else f"T{i - 1}"}
        for i in range(1, 6000)
    ]
    raw = cuts.cut(raw_transactions(spark, rows).repartition(16), "raw")
    with Conf(spark, **SMALL):
        tx = st.stage_transactions(raw)
        res = spark.createDataFrame([], "transaction_id string, resolution_date date")
        payments = cuts.cut(tr.linked_payments(tx, res), "payments")
        answers = tr.attach_linked(
            tx, payments, row_id="transaction_id", link="linked_transaction_id",
            names={"transaction_date": "linked_payment_date"},
        )
        assert "skew=true" in final_plan(answers)
        assert answers.count() == 6000


def test_a_hot_client_is_split(spark):
    rows = [
        {"transaction_id": f"T{i:06}", "transaction_date": "2024-01-01",
         "client_id": "HOT" if i % 2 else f"C{i}"}
        for i in range(8000)
    ]
    raw = cuts.cut(raw_transactions(spark, rows).repartition(16), "raw")
    contracts = cuts.cut(
        raw.select("client_id").distinct().selectExpr(
            "client_id", "date'2024-01-01' contract_start_date", "date'2024-02-01' contract_end_date",
            "1 spend_threshold", "0.1 discounted_fee_margin",
        ),
        "contracts",
    )
    converted = st.stage_transactions(raw).selectExpr(
        "*", "transaction_date spend_effective_date", "1 is_spend_qualifying",
        "cast(null as date) linked_payment_date", "cast(1 as decimal(18,2)) net_amount_gbp",
    )
    with Conf(spark, **SMALL):
        assert "skew=true" in final_plan(tr.apply_windows(converted, contracts))


def test_months_are_filled_after_all_sorts_and_totals(inputs, fact):
    """The dense rows of the mart, many times those with activity, are neither sorted nor windowed."""
    dates = date_spine(fact.sparkSession, "1995-01-01", "2003-01-01")
    windows = tr.contract_windows(st.stage_contracts(inputs.contracts))
    lines = plan(mo.client_monthly_revenue(fact, dates, windows)).splitlines()
    filled = next(i for i, line in enumerate(lines) if "Generate explode(sequence(" in line)
    assert not any("Window" in line or "- Sort " in line for line in lines[:filled])
    assert any("Window" in line for line in lines[filled:])


def test_rows_by_id_are_never_sent_to_the_driver(inputs):
    """Lookups by transaction id grow with the rows: merged, even where a broadcast would be allowed."""
    transactions = st.stage_transactions(inputs.transactions)
    resolutions = st.stage_resolutions(inputs.resolutions)
    payments = tr.linked_payments(transactions, resolutions)
    classified = tr.classify(st.flag_duplicate_refunds(transactions), resolutions, inputs.types, payments)
    assert "BroadcastExchange" not in final_plan(payments)
    assert final_plan(classified).count("BroadcastExchange") <= 1  # the types


def test_contracts_join_the_mart_before_months_are_filled(inputs, fact):
    """The dense rows are many times those with activity: no join, and parts of a number of their own."""
    dates = date_spine(fact.sparkSession, "1995-01-01", "2003-01-01")
    windows = tr.contract_windows(st.stage_contracts(inputs.contracts))
    lines = plan(mo.client_monthly_revenue(fact, dates, windows)).splitlines()
    filled = next(i for i, line in enumerate(lines) if "Generate explode(sequence(" in line)
    assert not any("Join" in line for line in lines[:filled])
    assert any("Join" in line for line in lines[filled:])
    assert any("REPARTITION_BY_NUM" in line for line in lines[filled:])


def test_values_of_checks_are_spread_in_generated_code(spark):
    """Without a lambda over each row's entries, and by check and value alone."""
    rows = spark.range(10).selectExpr("id", "id % 2 AS kind")
    listed = [
        runner.Check("rows", "unique", "id"),
        runner.Check("rows", "accepted_values", "kind", {"values": [0]}),
        runner.Check("rows", "relationships", "kind", {"parent": "rows", "field": "id"}),
    ]
    found = runner.run_checks(listed, {"rows": rows})
    text = plan(found)
    assert "inline(" in text and "lambda" not in text and "filter(array" not in text
    assert {r.check.split()[0]: r.failures for r in found.collect()} == {
        "unique": 0, "accepted_values": 1, "relationships": 0
    }


def test_a_client_with_two_contracts_keeps_single_totals(spark, inputs, fact):
    """Rows of the mart repeat by contract, their running totals do not."""
    dates = date_spine(fact.sparkSession, "1995-01-01", "2003-01-01")
    windows = cuts.cut(tr.contract_windows(st.stage_contracts(inputs.contracts)), "windows")
    once = mo.client_monthly_revenue(fact, dates, windows)
    twice = mo.client_monthly_revenue(fact, dates, windows.unionAll(windows))
    columns = ["client_month_id", "cumulative_contract_spend_gbp", "pending_chargebacks_gbp"]
    assert once.select(columns).exceptAll(twice.select(columns)).isEmpty()
    assert twice.select(columns).distinct().exceptAll(once.select(columns).distinct()).isEmpty()
