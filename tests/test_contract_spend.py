import random
from hashlib import md5
from itertools import accumulate

import pytest

from pyspark.sql import functions as F

from conftest import CONVERTED, WINDOWS, columns, frame
from ledgerline.operators.running import first_crossing, in_parts, running_total
from ledgerline.plans import transactions as tr


def spend(spark, contract, rows):
    converted = frame(
        spark, CONVERTED, [{"is_spend_qualifying": 1, "spend_effective_date": r["transaction_date"]} | r for r in rows]
    )
    windows = frame(spark, WINDOWS, [contract] if isinstance(contract, dict) else contract)
    return tr.contract_spend(converted, windows)


def result(df):
    return columns(df, "contract_spend_gbp", "running_contract_spend_gbp", "is_discount_earned")


def test_threshold_latch_and_contract_end(spark):
    contract = {"client_id": "C001", "contract_start_date": "2024-01-01",
                "contract_end_date": "2024-02-01", "spend_threshold": 1000,
                "discounted_fee_margin": "0.125"}
    rows = [
        {"transaction_id": id_, "client_id": "C001", "transaction_date": day, "net_amount_gbp": net}
        for id_, day, net in [
            ("T1", "2024-01-10", "602.5"), ("T2", "2024-01-20", "500.25"),
            ("T3", "2024-01-25", "100.5"), ("T4", "2024-02-05", "102.5"),
        ]
    ]
    assert result(spend(spark, contract, rows)) == {
        "T1": (602.5, 602.5, 0),
        "T2": (500.25, 1102.75, 1),
        "T3": (100.5, 1203.25, 1),
        "T4": (0.0, 1203.25, 0),
    }


def test_refund_of_a_payment_before_the_contract(spark):
    contract = {"client_id": "C004", "contract_start_date": "2024-03-01",
                "contract_end_date": "2024-12-01", "spend_threshold": 1000}
    rows = [
        {"transaction_id": "T1", "transaction_date": "2024-02-10", "net_amount_gbp": "502.5"},
        {"transaction_id": "T2", "transaction_date": "2024-03-01", "net_amount_gbp": "-502.5",
         "linked_payment_date": "2024-02-10"},
        {"transaction_id": "T3", "transaction_date": "2024-03-05", "net_amount_gbp": "1002.5"},
    ]
    rows = [row | {"client_id": "C004"} for row in rows]
    assert result(spend(spark, contract, rows)) == {
        "T1": (0.0, 0.0, 0),
        "T2": (0.0, 0.0, 0),
        "T3": (1002.5, 1002.5, 1),
    }


def test_chargebacks_count_only_inside_the_window(spark):
    contract = {"client_id": "C004", "contract_start_date": "2024-03-01",
                "contract_end_date": "2024-04-01", "spend_threshold": 1000}
    rows = [
        {"transaction_id": id_, "client_id": "C004", "transaction_date": day,
         "spend_effective_date": effective, "net_amount_gbp": net}
        for id_, day, effective, net in [
            ("CB1", "2024-02-25", "2024-03-03", "-100.5"),
            ("T1", "2024-03-05", "2024-03-05", "1002.5"),
            ("CB2", "2024-03-10", "2024-03-20", "-200.25"),
            ("CB3", "2024-03-25", "2024-04-05", "-50.5"),
        ]
    ]
    assert result(spend(spark, contract, rows)) == {
        "CB1": (0.0, 0.0, 0),
        "T1": (1002.5, 1002.5, 1),
        "CB2": (-200.25, 802.25, 1),  # falling below the threshold takes nothing back
        "CB3": (0.0, 802.25, 1),
    }


def test_no_contract_and_no_rate(spark):
    contract = {"client_id": "C1", "contract_start_date": "2024-01-01",
                "contract_end_date": "2025-01-01", "spend_threshold": 10}
    rows = [
        {"transaction_id": "T1", "client_id": "C1", "transaction_date": "2024-01-01"},  # no rate
        {"transaction_id": "T2", "client_id": "C1", "transaction_date": "2024-01-02", "net_amount_gbp": 5},
        {"transaction_id": "T3", "client_id": "C1", "transaction_date": "2024-01-03"},
        {"transaction_id": "T4", "client_id": "C1", "transaction_date": "2024-01-04", "net_amount_gbp": 5},
        {"transaction_id": "T5", "client_id": "C2", "transaction_date": "2024-01-04", "net_amount_gbp": 50},
        {"transaction_id": "T6", "client_id": "C1", "spend_effective_date": None, "transaction_date": None},
    ]
    assert result(spend(spark, contract, rows)) == {
        "T1": (None, None, None),
        "T2": (5.0, 5.0, 0),
        "T3": (None, 5.0, 0),
        "T4": (5.0, 10.0, 1),
        "T5": (None, None, None),
        "T6": (None, None, None),
    }


LEDGER = "c string, d date, id string, v decimal(18,2), t decimal(14,2)"
NAMES = {"key": "c", "day": "d", "row_id": "id", "value": "v"}


ORDER = {"key": "c", "day": "d", "row_id": "id"}
IDS = {
    "long": lambda i: f"T{i:09}",
    "short": lambda i: f"T{i % 10**6:06}",
    "md5": lambda i: md5(str(i).encode()).hexdigest(),
}


@pytest.fixture(params=[True, False], ids=["coalesced", "parted"])
def parts(spark, request):
    """With and without Spark putting small parts together."""
    name = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(name, request.param)
    yield
    spark.conf.unset(name)


@pytest.mark.parametrize("ids", IDS)
def test_running_total_and_crossing_against_brute_force(spark, parts, ids):
    """Few days and many rows on each."""
    rng = random.Random(ids)
    rows = [
        {
            "c": rng.choice("ABBBBBB"),
            "d": f"2024-01-{rng.randrange(1, 5):02}",
            "id": IDS[ids](i),
            "v": None if rng.random() < 0.1 else rng.randrange(-50, 60),
            "t": 400,
        }
        for i in rng.sample(range(10**9), 400)
    ]
    ledger = frame(spark, LEDGER, rows)
    running = columns(
        running_total(in_parts(ledger, **ORDER), out="r", **NAMES), "r", key="id"
    )
    crossings = {
        row.c: row
        for row in first_crossing(in_parts(ledger, **ORDER), threshold="t", **NAMES).collect()
    }
    expected, places = {}, {}
    for client in "AB":
        mine = sorted((r for r in rows if r["c"] == client), key=lambda r: (r["d"], r["id"]))
        sums = accumulate(r["v"] or 0 for r in mine)
        seen = False
        for row, total in zip(mine, sums):
            seen = seen or row["v"] is not None
            expected[row["id"]] = (float(total) if seen else None,)
            if seen and total >= 400:
                places.setdefault(client, row["id"])
    assert running == expected
    assert {c: r.crossing and r.crossing.id for c, r in crossings.items()} == {
        c: places.get(c) for c in crossings
    }


def test_crossing_inside_a_day_that_ends_below(spark):
    rows = [
        {"c": "A", "d": "2024-01-01", "id": "T1", "v": 90, "t": 100},
        {"c": "A", "d": "2024-01-02", "id": "T2", "v": 20, "t": 100},
        {"c": "A", "d": "2024-01-02", "id": "T3", "v": -50, "t": 100},
        {"c": "A", "d": "2024-01-03", "id": "T4", "v": 500, "t": 100},
    ]
    crossing = first_crossing(in_parts(frame(spark, LEDGER, rows), **ORDER), threshold="t", **NAMES).first().crossing
    assert crossing.id == "T2"


def test_threshold_of_zero_is_reached_at_once(spark):
    rows = [
        {"c": "A", "d": "2024-01-01", "id": "T1", "v": 0, "t": 0},
        {"c": "A", "d": "2024-01-02", "id": "T2", "v": 20, "t": 0},
    ]
    crossing = first_crossing(in_parts(frame(spark, LEDGER, rows), **ORDER), threshold="t", **NAMES).first().crossing
    assert crossing.id == "T1"


@pytest.mark.parametrize("ids", IDS)
def test_one_hot_day_is_parted_evenly(spark, ids):
    """Two thirds of all rows are one client's on one day."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", False)
    rows = [("HOT" if i % 3 else f"C{i}", IDS[ids](i * 7919), 1) for i in range(20_000)]
    ledger = spark.createDataFrame(rows, "c string, id string, v int").withColumn("d", F.current_date())
    made = in_parts(ledger, **ORDER)
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    sizes = [r["count"] for r in made.groupBy("_part").count().collect()]
    hot = made.where("c = 'HOT'").groupBy("_part").count().count()
    assert len(sizes) == 4 and max(sizes) < 2 * 20_000 / 4 and hot >= 3
    ends = made.groupBy("_part").agg(F.min(F.struct("c", "d", "id")), F.max(F.struct("c", "d", "id"))).sort("_part")
    bounds = [tuple(x) for r in ends.collect() for x in r[1:]]
    assert bounds == sorted(bounds)


def test_repeated_and_missing_ids_keep_their_rows(spark):
    contract = {"client_id": "C1", "contract_start_date": "2024-01-01",
                "contract_end_date": "2025-01-01", "spend_threshold": 25}
    rows = [
        {"transaction_id": id_, "client_id": "C1", "transaction_date": "2024-01-02", "net_amount_gbp": 10}
        for id_ in ("T1", "T1", None, None)
    ]
    found = spend(spark, contract, rows).collect()
    assert sorted(float(r["running_contract_spend_gbp"]) for r in found) == [10, 20, 30, 40]
