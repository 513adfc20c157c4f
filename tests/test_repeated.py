"""Repeated ids, fine rates and large keys."""

from decimal import Decimal

from pyspark.sql import functions as F

from ledgerline.operators.linked import attach_linked, flag_later_in_group
from ledgerline.plans.staging import stage_rates
from ledgerline.sources.bridge import _id


def test_rows_of_one_id_keep_to_their_own_links(spark):
    schema = "id string, link string, n int"
    rows = [("Y", "P1", 1), ("Y", "P2", 2), ("Y", None, 3), ("X", "P1", 4), ("X", None, 5), ("P1", None, 6)]
    table = spark.createDataFrame(rows, schema)
    linked = spark.createDataFrame([("P1", "one")], "id string, what string")
    found = attach_linked(table, linked, row_id="id", link="link", names={"what": "of_link"})
    got = {r["n"]: r["of_link"] for r in found.collect()}
    assert found.count() == 6
    assert got == {1: "one", 2: None, 3: None, 4: "one", 5: None, 6: None}


def test_rates_are_not_rounded(spark):
    raw = spark.createDataFrame(
        [("2024-01-01", "JPY", "0.005234")], "rate_date string, currency string, exchange_rate_to_gbp string"
    )
    assert stage_rates(raw).first()["exchange_rate_to_gbp"] == Decimal("0.005234")


def test_large_keys_stay_apart(spark):
    keys = spark.createDataFrame([(1234567890123,), (1234567890124,), (2**63 - 1,)], "k long")
    assert keys.select(_id("T", F.col("k")).alias("id")).distinct().count() == 3


def test_copies_of_a_first_refund_are_told_apart(spark):
    """Against row_number by link, date and id, with missing ids and links and a place that a third share."""
    rows = [("p", "payment", None, "1")] * 2
    rows += [("a", "refund", "p", "1"), ("a", "refund", "p", "1"), ("b", "refund", "p", "2")]
    rows += [("c", "refund", "q", "3"), ("d", "refund", "q", "3"), ("d", "refund", "q", "3")]
    rows += [(None, "refund", "r", "1"), (None, "refund", "r", "1"), ("e", "refund", "r", "1")]
    rows += [(None, "refund", None, None)] * 3 + [("f", "refund", None, "1"), ("g", "refund", None, None)]
    rows += [("h", "refund", "s", "9")] * 30 + [("i", "refund", "s", "8"), ("k", "refund", "t", "5")]
    schema = "id string, type string, link string, day string"
    table = spark.createDataFrame(rows, schema).repartition(4)
    made = flag_later_in_group(
        table, group="link", order=["day"], row_id="id", where=F.col("type") == "refund", flag="later"
    )
    expected, met = [], set()
    key = lambda r: tuple((v is not None, v or "") for v in (r[2], r[3], r[0]))
    for row in sorted(rows, key=key):
        later = row[1] == "refund" and row[2] in met
        if row[1] == "refund":
            met.add(row[2])
        expected.append((*row, int(later)))
    found = [tuple(r) for r in made.select("id", "type", "link", "day", "later").collect()]
    assert sorted(found, key=str) == sorted(expected, key=str)
