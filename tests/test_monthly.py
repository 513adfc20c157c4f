import pytest

from conftest import FACT, TESTDATA, WINDOWS, columns, frame
from ledgerline.operators.spine import date_spine
from ledgerline.plans import metrics as me, monthly as mo, staging as st, transactions as tr
from ledgerline.quality.checks import reconcile
from ledgerline.sources.bridge import bridge


def chargebacks(spark):
    return frame(
        spark,
        FACT,
        [
            {"transaction_id": "P1", "client_id": "C005", "transaction_date": "2024-01-10",
             "recognition_date": "2024-01-10", "spend_effective_date": "2024-01-10",
             "amount_direction": 1, "gross_amount_gbp": "100.5", "net_amount_gbp": "100.5",
             "is_revenue_recognised": 1, "revenue_gbp": "25.125"},
            {"transaction_id": "CB1", "client_id": "C005", "transaction_date": "2024-01-20",
             "resolution_status": "resolved", "resolution_date": "2024-02-05",
             "recognition_date": "2024-02-05", "spend_effective_date": "2024-02-05",
             "amount_direction": -1, "gross_amount_gbp": "200.25", "net_amount_gbp": "-200.25",
             "is_revenue_recognised": 1, "revenue_gbp": "-50.0625"},
            {"transaction_id": "CB2", "client_id": "C005", "transaction_date": "2024-01-25",
             "resolution_status": "pending", "spend_effective_date": "2024-01-25",
             "amount_direction": -1, "gross_amount_gbp": "150.5", "net_amount_gbp": "-150.5",
             "is_revenue_recognised": 0, "revenue_gbp": "0"},
        ],
    )


def months(df, *names, client=None):
    if client is not None:
        df = df.where(df.client_id == client)
    return {str(k)[:7]: v for k, v in columns(df, *names, key="month_start_date").items()}


def test_chargebacks_move_between_months(spark):
    dates = date_spine(spark, "2024-01-01", "2024-03-01")
    df = mo.client_monthly_revenue(chargebacks(spark), dates, frame(spark, WINDOWS, []))
    assert months(
        df, "recognised_gross_gmv_gbp", "recognised_net_gmv_gbp", "recognised_revenue_gbp",
        "originated_net_gmv_gbp", "originated_revenue_gbp", "pending_chargebacks_gbp",
        "is_partial_month", "contract_status",
    ) == {
        "2024-01": (100.5, 100.5, 25.125, -99.75, -24.9375, 350.75, 0, "no contract"),
        "2024-02": (0, -200.25, -50.0625, 0, 0, 150.5, 1, "no contract"),
    }
    pending = mo.pending_at_month_end(chargebacks(spark), dates)
    assert months(pending, "pending_chargebacks_gbp") == {"2024-01": (350.75,), "2024-02": (150.5,)}


def test_contract_and_discount_status(spark):
    windows = frame(
        spark, WINDOWS,
        [{"client_id": "C001", "contract_start_date": "2024-02-01",
          "contract_end_date": "2024-03-01", "spend_threshold": 500}],
    )
    fact = frame(
        spark, FACT,
        [
            {"transaction_id": id_, "client_id": "C001", "transaction_date": day,
             "recognition_date": day, "spend_effective_date": day, "amount_direction": 1,
             "gross_amount_gbp": net, "net_amount_gbp": net, "is_revenue_recognised": 1,
             "is_in_contract_period": inside, "contract_spend_gbp": spend,
             "is_discount_earned": earned, "revenue_gbp": revenue}
            for id_, day, net, inside, spend, earned, revenue in [
                ("P0", "2024-01-15", "100.5", 0, "0", 0, "25.125"),
                ("P1", "2024-02-10", "600.5", 1, "600.5", 1, "75.0625"),
                ("P2", "2024-03-15", "100.5", 0, "0", 0, "25.125"),
            ]
        ],
    )
    df = mo.client_monthly_revenue(fact, date_spine(spark, "2024-01-01", "2024-04-01"), windows)
    got = months(
        df, "contract_status", "cumulative_contract_spend_gbp", "discount_earned_date",
        "is_discount_active", "pct_of_spend_threshold",
    )
    assert {k: (v[0], v[1], v[2] and str(v[2]), *v[3:]) for k, v in got.items()} == {
        "2024-01": ("not started", 0, None, 0, 0),
        "2024-02": ("active", 600.5, "2024-02-10", 1, 1.201),
        "2024-03": ("ended", 600.5, "2024-02-10", 0, 1.201),
    }
    naive = mo.naive_threshold_comparison(df, fact)
    assert months(naive, "naive_cumulative_gross_spend_gbp", "is_threshold_reached",
                  "is_naive_threshold_reached") == {
        "2024-01": (0, 0, 0), "2024-02": (600.5, 1, 1), "2024-03": (600.5, 1, 1)
    }


def pending_fact(spark):
    def row(id_, client, day, resolved=None, gross="10"):
        status = "pending" if resolved is None else "resolved"
        return {"transaction_id": id_, "client_id": client, "transaction_date": day,
                "resolution_status": status, "resolution_date": resolved,
                "spend_effective_date": resolved or day, "amount_direction": -1,
                "gross_amount_gbp": gross, "is_revenue_recognised": 0}

    return frame(
        spark, FACT,
        [
            row("A1", "A", "2024-01-10"),
            row("A2", "A", "2024-02-10", "2024-02-20"),  # resolved in its own month
            row("A3", "A", "2024-02-10", "2024-04-01"),
            row("B1", "B", "2024-03-31", "2024-03-01"),  # resolved before it happened
            row("B2", "B", "2024-05-01", gross=None),
            {"transaction_id": "D1", "client_id": "D", "is_revenue_recognised": 0},  # no date
        ],
    )


def test_pending_over_months_and_clients_without_activity(spark):
    dates = date_spine(spark, "2024-01-01", "2024-12-01")
    df = mo.client_monthly_revenue(pending_fact(spark), dates, frame(spark, WINDOWS, []))
    pending = "pending_chargebacks_gbp"
    assert months(df, pending, client="A") == {
        "2024-01": (10,), "2024-02": (20,), "2024-03": (20,), "2024-04": (10,), "2024-05": (10,)
    }
    assert set(months(df, pending, client="B").values()) == {(0,)}
    assert months(df, pending, client="D") == {f"2024-0{n}": (0,) for n in range(1, 6)}
    rows = mo.pending_at_month_end(pending_fact(spark), dates).collect()
    assert {(r.client_id, str(r.month_start_date)[:7]) for r in rows} == {
        *(("A", f"2024-0{n}") for n in range(1, 6)), ("B", "2024-05")
    }
    assert [r.pending_chargebacks_gbp for r in rows if r.client_id == "B"] == [None]  # no rate


def test_spine_that_starts_after_the_data(spark):
    """What happened before the first month reported is not counted, but still pending."""
    dates = date_spine(spark, "2024-03-01", "2024-12-01")
    df = mo.client_monthly_revenue(pending_fact(spark), dates, frame(spark, WINDOWS, []))
    assert months(df, "pending_chargebacks_gbp", client="A") == {
        "2024-03": (20,), "2024-04": (10,), "2024-05": (10,)
    }
    early = mo.client_monthly_revenue(chargebacks(spark), date_spine(spark, "2024-02-01", "2024-04-01"),
                                      frame(spark, WINDOWS, []))
    assert months(early, "recognised_net_gmv_gbp", "originated_net_gmv_gbp") == {
        "2024-02": (-200.25, 0)
    }


@pytest.fixture(scope="module")
def marts(spark):
    inputs = bridge(spark, TESTDATA)
    fact = tr.fct_transactions(inputs).persist()
    windows = tr.contract_windows(st.stage_contracts(inputs.contracts))
    dates = date_spine(spark, "1995-01-01", "2003-01-01")
    return fact, mo.client_monthly_revenue(fact, dates, windows).persist()


def test_mart_is_dense_and_reconciles(marts):
    fact, monthly = marts
    clients = fact.select("client_id").distinct().count()
    spans = monthly.select("month_start_date").distinct().count()
    assert monthly.count() == clients * spans
    assert reconcile(monthly, fact).count() == 0
    assert reconcile(monthly, fact.where("transaction_type != 'refund'")).count() > 0


def test_parts_agree_with_the_mart(marts):
    fact, monthly = marts
    for part, names in [
        (mo.recognised_by_month(fact), ["recognised_revenue_gbp", "recognised_transaction_count"]),
        (mo.originated_by_month(fact), ["originated_net_gmv_gbp"]),
        (mo.contract_spend_by_month(fact), ["monthly_contract_spend_gbp"]),
    ]:
        keys = ["client_id", "month_start_date"]
        assert part.select(*keys, *names).exceptAll(monthly.select(*keys, *names)).count() == 0


def test_metrics(marts):
    fact, monthly = marts
    total = me.metric_query(fact, list(me.METRICS)).first()
    sums = monthly.selectExpr(
        "sum(recognised_revenue_gbp) r", "sum(recognised_net_gmv_gbp) n",
        "sum(recognised_gross_gmv_gbp) g",
    ).first()
    assert (total.revenue, total.net_gmv, total.gross_gmv) == (sums.r, sums.n, sums.g)
    assert total.take_rate == pytest.approx(float(total.revenue) / float(total.net_gmv))
    assert total.transactions == fact.count()

    by_month = me.metric_query(fact, ["revenue", "transactions"], time_grain="month")
    assert by_month.selectExpr("sum(revenue)").first()[0] == total.revenue
    assert by_month.selectExpr("sum(transactions)").first()[0] == total.transactions


def test_metric_without_rows_in_a_group_is_null(spark):
    rows = [
        {"transaction_id": "A", "transaction_date": "2024-01-31", "recognition_date": "2024-03-01",
         "is_revenue_recognised": 1, "net_amount_gbp": 0, "revenue_gbp": 0},
        {"transaction_id": "B", "transaction_date": "2024-01-31", "is_revenue_recognised": 0},
    ]
    df = me.metric_query(
        frame(spark, FACT, rows), ["transactions", "revenue", "take_rate"], time_grain="quarter",
    )
    assert [tuple(r)[1:] for r in df.collect()] == [(2, 0, None)]  # one quarter, no net GMV
    df = me.metric_query(frame(spark, FACT, rows), ["transactions", "revenue"], time_grain="month")
    got = {str(r.metric_time): (r.transactions, r.revenue) for r in df.collect()}
    assert got == {"2024-01-01": (2, None), "2024-03-01": (None, 0)}


@pytest.mark.parametrize(
    "query", [{"metrics": ["profit"]}, {"metrics": ["revenue"], "group_by": ["country"]},
              {"metrics": ["revenue"], "time_grain": "hour"}]
)
def test_unknown_names_are_refused(spark, query):
    with pytest.raises(ValueError):
        me.metric_query(frame(spark, FACT, []), **query)


def test_rollup_follows_additivity(marts):
    _, monthly = marts
    year = me.rollup_months(monthly, "year", by_client=False)
    row = year.where("period_start_date = '1997-01-01'").first()
    in_year = monthly.where("year(month_start_date) = 1997")
    december = in_year.where("month(month_start_date) = 12")
    assert row.recognised_revenue_gbp == in_year.selectExpr("sum(recognised_revenue_gbp)").first()[0]
    assert (
        row.pending_chargebacks_gbp == december.selectExpr("sum(pending_chargebacks_gbp)").first()[0]
    )
    with pytest.raises(ValueError):
        me.rollup_months(monthly, "year", ["pct_of_spend_threshold"])


def test_totals_before_the_first_activity_and_from_outside_the_months(spark):
    """Pending before the spine counts from its first month; a client's totals are 0 until it is active."""
    rows = [
        {"transaction_id": "A1", "client_id": "C001", "transaction_date": "2023-12-20",
         "resolution_status": "pending", "spend_effective_date": "2023-12-20",
         "gross_amount_gbp": "10", "net_amount_gbp": "-10", "is_revenue_recognised": 0},
        {"transaction_id": "A2", "client_id": "C001", "transaction_date": "2024-01-05",
         "resolution_status": "pending", "spend_effective_date": "2024-01-05",
         "gross_amount_gbp": "5", "net_amount_gbp": "-5", "is_revenue_recognised": 0},
        {"transaction_id": "B1", "client_id": None, "transaction_date": "2024-03-02",
         "resolution_status": "resolved", "resolution_date": "2024-04-01",
         "spend_effective_date": "2024-04-01", "gross_amount_gbp": "7", "net_amount_gbp": "-7",
         "is_revenue_recognised": 0},
        {"transaction_id": "D1", "client_id": "C002", "gross_amount_gbp": "1"},
    ]
    dates = date_spine(spark, "2024-01-01", "2024-05-01")
    mart = mo.client_monthly_revenue(frame(spark, FACT, rows), dates, frame(spark, WINDOWS, []))
    found = {(r.client_id, str(r.month_start_date)[:7]): float(r.pending_chargebacks_gbp) for r in mart.collect()}
    months = [f"2024-0{m}" for m in (1, 2, 3, 4)]
    assert [found["C001", m] for m in months] == [15, 15, 15, 15]
    assert [found[None, m] for m in months] == [0, 0, 7, 0]
    assert [found["C002", m] for m in months] == [0, 0, 0, 0]
    assert len(found) == 12


def test_each_month_of_a_transaction_once_in_generated_code(spark):
    """Months may be equal or NULL in any place; without any, the transaction still shows its client."""
    days = [
        ("2024-01-10", "2024-01-31", "2024-02-01", "2024-02-02"), ("2024-03-01",) * 4, (None,) * 4,
        (None, "2024-01-10", "2024-01-11", None), ("2024-02-01", None, "2024-01-01", "2024-02-03"),
    ]
    rows = [
        {"client_id": f"C{i}", "transaction_date": t, "recognition_date": r, "spend_effective_date": e,
         "resolution_date": u, "resolution_status": "resolved"}
        for i, (t, r, e, u) in enumerate(days)
    ]
    activity = mo.monthly_activity(frame(spark, FACT, rows))
    text = activity._jdf.queryExecution().executedPlan().toString()
    assert "lambda" not in text and "filter(array" not in text
    found = sorted((r.client_id, str(r.month_start_date)[:7]) for r in activity.collect())
    expected = {(f"C{i}", str(day)[:7]) for i, four in enumerate(days) for day in four if day}
    assert found == sorted(expected | {("C2", "None")})
