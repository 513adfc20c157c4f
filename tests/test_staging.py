from decimal import Decimal

from conftest import columns, frame, raw_transactions
from ledgerline.plans import staging as st


def test_stage_transactions_types_and_bad_values(spark):
    raw = raw_transactions(
        spark,
        [
            {"transaction_id": "T1", "transaction_amount": "1234567.10", "currency": "GBP",
             "transaction_date": "2024-01-05", "platform_fee_margin": "0.175"},
            {"transaction_id": "T2", "transaction_date": "05/01/2024"},
        ],
    )
    first, second = sorted(st.stage_transactions(raw).collect(), key=lambda r: r.transaction_id)
    assert first.transaction_amount == Decimal("1234567.10")
    assert first.platform_fee_margin == Decimal("0.175")  # not rounded to two places
    assert first.transaction_currency == "GBP"
    assert second.transaction_date is None


def staged(spark, rows):
    return st.stage_transactions(raw_transactions(spark, rows))


def test_only_the_first_refund_of_a_payment_counts(spark):
    def refund(id_, link, day):
        return {"transaction_id": id_, "transaction_type": "refund",
                "linked_transaction_id": link, "transaction_date": day}

    rows = [
        {"transaction_id": "T1", "transaction_type": "payment", "transaction_date": "2024-01-01"},
        {"transaction_id": "T2", "transaction_type": "payment", "transaction_date": "2024-01-01"},
        refund("T9", "T1", "2024-01-05"),
        refund("T8", "T1", "2024-01-05"),  # same day: the lower id is first
        refund("T7", "T1", "2024-01-06"),
        refund("T6", "T2", "2024-02-01"),
        refund("T4", None, "2024-02-01"),  # refunds without a link are one group
        refund("T5", None, "2024-02-01"),
    ]
    flags = columns(st.flag_duplicate_refunds(staged(spark, rows)), "is_duplicate_refund")
    assert {k: v[0] for k, v in flags.items()} == {
        "T1": 0, "T2": 0, "T8": 0, "T9": 1, "T7": 1, "T6": 0, "T4": 0, "T5": 1
    }


def test_a_link_of_another_type_is_no_duplicate(spark):
    rows = [
        {"transaction_id": "T1", "transaction_type": "chargeback", "linked_transaction_id": "T0"},
        {"transaction_id": "T2", "transaction_type": "chargeback", "linked_transaction_id": "T0"},
    ]
    flags = columns(st.flag_duplicate_refunds(staged(spark, rows)), "is_duplicate_refund")
    assert set(flags.values()) == {(0,)}


def test_stage_resolutions(spark):
    raw = frame(
        spark,
        "transaction_id string, resolution_status string, resolution_date string",
        [
            {"transaction_id": "T1", "resolution_status": "resolved", "resolution_date": "13/01/2024"},
            {"transaction_id": "T2", "resolution_status": "pending", "resolution_date": ""},
        ],
    )
    dates = columns(st.stage_resolutions(raw), "resolution_date")
    assert str(dates["T1"][0]) == "2024-01-13" and dates["T2"] == (None,)


def test_stage_rates_key(spark):
    raw = frame(
        spark,
        "currency string, rate_date string, exchange_rate_to_gbp decimal(8,4)",
        [{"currency": "GBP", "rate_date": "2024-01-01", "exchange_rate_to_gbp": "1"}],
    )
    assert st.stage_rates(raw).first().currency_rate_id == "GBP-2024-01-01"
