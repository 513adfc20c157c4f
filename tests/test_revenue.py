from conftest import TESTDATA, columns, frame, raw_transactions
from ledgerline.plans import staging as st, transactions as tr
from ledgerline.sources.bridge import bridge
from ledgerline.sources.tables import transaction_types

WITH_SPEND = """
    transaction_id string, transaction_date date, client_id string, transaction_type string,
    transaction_currency string, platform_fee_margin decimal(4,3), amount_direction int,
    gross_amount_local decimal(14,2), net_amount_local decimal(14,2), gross_amount_gbp decimal(18,2),
    net_amount_gbp decimal(18,2), resolution_status string, resolution_date date,
    linked_transaction_id string, is_duplicate_refund int, spend_effective_date date,
    is_revenue_recognised int, is_spend_qualifying int, discounted_fee_margin decimal(4,3),
    is_in_contract_period int, contract_spend_gbp decimal(18,2),
    running_contract_spend_gbp decimal(18,2), is_discount_earned int"""


def priced(spark, rows):
    rows = [{"platform_fee_margin": "0.25", "is_revenue_recognised": 1} | row for row in rows]
    return tr.price_revenue(frame(spark, WITH_SPEND, rows))


def row(id_, day, net, inside=None, earned=None, **more):
    return {"transaction_id": id_, "spend_effective_date": day, "net_amount_gbp": net,
            "is_in_contract_period": inside, "is_discount_earned": earned} | more


def test_margin_and_recognition_date(spark):
    discounted = {"discounted_fee_margin": "0.125"}
    df = priced(
        spark,
        [
            row("R1", "2024-03-01", "100.5", 1, 1, **discounted),
            row("R2", "2024-03-02", "100.5", 1, 0, **discounted),
            row("R3", "2024-03-03", "100.5"),
            row("R4", "2024-03-04", "-100.5", is_revenue_recognised=0),
        ],
    )
    got = columns(df, "applicable_fee_margin", "revenue_gbp")
    assert got == {
        "R1": (0.125, 12.5625), "R2": (0.25, 25.125), "R3": (0.25, 25.125), "R4": (0.25, 0.0)
    }
    dates = columns(df, "recognition_date")
    assert str(dates["R1"][0]) == "2024-03-01" and dates["R4"] == (None,)


def test_refund_reverses_at_the_payments_margin(spark):
    discounted = {"discounted_fee_margin": "0.125"}
    df = priced(
        spark,
        [
            row("P1", "2024-03-01", "100.5", 1, 0, **discounted),
            row("R1", "2024-03-20", "-100.5", 1, 1, linked_transaction_id="P1", **discounted),
            row("P2", "2024-06-20", "200.25", 1, 1, **discounted),
            row("R2", "2024-07-05", "-200.25", 0, 0, linked_transaction_id="P2", **discounted),
            row("R3", "2024-07-05", "-10", 0, 0, linked_transaction_id="P9", **discounted),
        ],
    )
    assert columns(df, "applicable_fee_margin", "revenue_gbp") == {
        "P1": (0.25, 25.125), "R1": (0.25, -25.125),
        "P2": (0.125, 25.03125), "R2": (0.125, -25.03125),
        "R3": (0.25, -2.5),  # its payment is unknown
    }


def classified(spark, transactions, resolutions=()):
    tx = st.flag_duplicate_refunds(st.stage_transactions(raw_transactions(spark, transactions)))
    res = frame(
        spark, "transaction_id string, resolution_status string, resolution_date date", list(resolutions)
    )
    return tr.classify(tx, res, transaction_types(spark))


def test_classify_by_type(spark):
    rows = [
        {"transaction_id": id_, "transaction_type": type_, "transaction_amount": "10",
         "transaction_date": "2024-01-01", "linked_transaction_id": link}
        for id_, type_, link in [
            ("P", "payment", None), ("F", "fraud", None), ("C1", "chargeback", None),
            ("C2", "chargeback", None), ("C3", "chargeback", None), ("R1", "refund", "P"),
            ("R2", "refund", "P"), ("U", "unknown", None),
        ]
    ]
    resolutions = [
        {"transaction_id": "C1", "resolution_status": "resolved", "resolution_date": "2024-02-03"},
        {"transaction_id": "C2", "resolution_status": "pending"},
    ]
    df = classified(spark, rows, resolutions)
    assert columns(df, "net_amount_local", "is_revenue_recognised", "is_spend_qualifying") == {
        "P": (10, 1, 1), "F": (10, 0, 0), "C1": (-10, 1, 1), "C2": (-10, 0, 0),
        "C3": (-10, 0, 0), "R1": (-10, 1, 1), "R2": (-10, 0, 0), "U": (None, None, None),
    }
    dates = {k: [v and str(v) for v in row] for k, row in columns(
        df, "spend_effective_date", "linked_payment_date").items()}
    assert dates["C1"] == ["2024-02-03", None]
    assert dates["R1"] == ["2024-01-01", "2024-01-01"]
    assert df.columns == tr.CLASSIFIED


def test_links_keep_rows_and_fan_out_only_with_the_payment(spark):
    """A link to nothing keeps its row; a payment delivered twice matches twice."""
    rows = [
        {"transaction_id": "P", "transaction_type": "payment", "transaction_date": "2024-01-01"},
        {"transaction_id": "P", "transaction_type": "payment", "transaction_date": "2024-01-02"},
        {"transaction_id": "R", "transaction_type": "refund", "linked_transaction_id": "P"},
        {"transaction_id": "S", "transaction_type": "refund", "linked_transaction_id": "none"},
    ]
    got = sorted(
        (r.transaction_id, str(r.linked_payment_date)) for r in classified(spark, rows).collect()
    )
    assert got == [
        ("P", "None"), ("P", "None"), ("R", "2024-01-01"), ("R", "2024-01-02"), ("S", "None")
    ]


def test_the_short_way_equals_the_steps(spark):
    inputs = bridge(spark, TESTDATA)
    tx = st.flag_duplicate_refunds(st.stage_transactions(inputs.transactions))
    rows = tr.classify(tx, st.stage_resolutions(inputs.resolutions), inputs.types)
    rows = tr.convert_to_gbp(rows, tr.daily_rates(st.stage_rates(inputs.rates)))
    windows = tr.contract_windows(st.stage_contracts(inputs.contracts))
    by_steps = tr.price_revenue(tr.contract_spend(rows, windows)).collect()
    assert sorted(by_steps, key=str) == sorted(tr.fct_transactions(inputs).collect(), key=str)
    assert len(by_steps) == tx.count()
