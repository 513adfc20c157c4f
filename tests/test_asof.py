import random

from conftest import columns, frame
from ledgerline.operators.asof import asof_join, daily_lookup

RATES = "currency string, rate_date date, rate decimal(8,4)"
KEYS = {"key": ("cur", "currency"), "day": ("day", "rate_date"), "value": "rate"}


def lookup(spark, rates, rows):
    daily = daily_lookup(frame(spark, RATES, rates), "currency", "rate_date", "rate")
    df = frame(spark, "id int, cur string, day date", rows)
    return {k: v[0] for k, v in columns(asof_join(df, daily, **KEYS), "rate", key="id").items()}


def test_gaps_take_the_latest_earlier_rate(spark):
    rates = [
        {"currency": "USD", "rate_date": "2024-01-01", "rate": "0.8"},
        {"currency": "USD", "rate_date": "2024-01-05", "rate": "0.75"},
    ]
    days = {1: "2024-01-03", 2: "2024-01-05", 3: "2024-01-10", 4: "2023-12-31", 5: None}
    rows = [{"id": i, "cur": "USD", "day": d} for i, d in days.items()]
    assert lookup(spark, rates, rows) == {1: 0.8, 2: 0.75, 3: 0.75, 4: None, 5: None}


def test_a_currency_whose_rates_end_early_carries_forward(spark):
    rates = [
        {"currency": "USD", "rate_date": "2024-01-01", "rate": "0.8"},
        {"currency": "EUR", "rate_date": "2024-01-09", "rate": "0.9"},
    ]
    rows = [
        {"id": 1, "cur": "USD", "day": "2024-01-08"},
        {"id": 2, "cur": "USD", "day": "2024-03-01"},
        {"id": 3, "cur": "EUR", "day": "2024-01-08"},
        {"id": 4, "cur": "JPY", "day": "2024-01-08"},
    ]
    assert lookup(spark, rates, rows) == {1: 0.8, 2: 0.8, 3: None, 4: None}


def test_of_two_rates_on_one_day_the_higher_counts(spark):
    rates = [
        {"currency": "USD", "rate_date": "2024-01-01", "rate": r} for r in ("0.8", "0.7", "0.75")
    ]
    assert lookup(spark, rates, [{"id": 1, "cur": "USD", "day": "2024-01-02"}]) == {1: 0.8}


def test_against_brute_force(spark):
    rng = random.Random(7)
    rates, rows = [], []
    for currency in "ABC":
        for n in sorted(rng.sample(range(1, 60), 12)):
            rates.append({"currency": currency, "rate_date": f"2024-{n // 28 + 1:02}-{n % 28 + 1:02}",
                          "rate": str(n)})
    for i in range(300):
        n = rng.randrange(80)
        rows.append({"id": i, "cur": rng.choice("ABC"), "day": f"2024-{n // 28 + 1:02}-{n % 28 + 1:02}"})

    def expected(row):
        earlier = [
            r for r in rates if r["currency"] == row["cur"] and r["rate_date"] <= row["day"]
        ]
        return float(max(earlier, key=lambda r: r["rate_date"])["rate"]) if earlier else None

    assert lookup(spark, rates, rows) == {row["id"]: expected(row) for row in rows}
