"""The five input tables, derived from the test tables ``orders`` and ``customer``.

Every order becomes a transaction; some also become a refund or a second refund. The
remainders of keys below only decide what kind of transaction an order stands for.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .. import schemas
from ..operators.cuts import cut, scratch_path
from ..plans.transactions import Inputs
from .tables import transaction_types

#: Any 64-bit number fits; fewer digits would cut large keys off.
ID_DIGITS = 19


def _order_key() -> Column:
    return F.col("o_orderkey")


def _order_day() -> Column:
    return F.col("o_orderdate").cast("date")


def _id(letter: str, number: Column) -> Column:
    return F.concat(F.lit(letter), F.lpad(number.cast("string"), ID_DIGITS, "0"))


def _plus_days(days: Column) -> Column:
    return F.date_add(_order_day(), days.cast("int"))


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/orders.parquet")


def bridge_transactions(spark: SparkSession, sf_dir: str, dirty: bool = False) -> DataFrame:
    """With ``dirty``, orders with some remainders by 997 break one rule each."""
    k, c, day = _order_key(), F.col("o_custkey"), _order_day()
    kind = (
        F.when(k % 20 == 7, "fraud").when(k % 10 == 3, "chargeback").otherwise("payment")
    )
    client = _id("C", c)
    amount = F.col("o_totalprice").cast(schemas.AMOUNT)
    index = ((k + c) % 3 + 1).cast("int")
    # Spark takes an element of an array without NULLs as never NULL, whatever the index
    currency = F.when(
        index.isNotNull(), F.element_at(F.array(F.lit("GBP"), F.lit("USD"), F.lit("EUR")), index)
    )
    link = F.lit(None).cast("string")

    def broken(remainder: int, bad: Column, good: Column) -> Column:
        return F.when(k % 997 == remainder, bad).otherwise(good) if dirty else good

    def row(offset: int, type_: Column, date: Column, link_: Column) -> Column:
        return F.struct(
            _id("T", 3 * k + offset).alias("transaction_id"),
            client.alias("client_id"),
            amount.alias("transaction_amount"),
            type_.alias("transaction_type"),
            F.date_format(date, "yyyy-MM-dd").alias("transaction_date"),
            F.lit("0.200").cast(schemas.MARGIN).alias("platform_fee_margin"),
            currency.alias("currency"),
            link_.alias("linked_transaction_id"),
        )

    base = F.struct(
        _id("T", 3 * k).alias("transaction_id"),
        broken(1, F.lit("X1"), client).alias("client_id"),
        broken(2, F.lit(0).cast(schemas.AMOUNT), amount).alias("transaction_amount"),
        broken(3, F.lit("unknown"), kind).alias("transaction_type"),
        F.date_format(day, "yyyy-MM-dd").alias("transaction_date"),
        F.lit("0.200").cast(schemas.MARGIN).alias("platform_fee_margin"),
        broken(4, F.lit("JPY"), currency).alias("currency"),
        broken(5, F.lit("T-missing"), link).alias("linked_transaction_id"),
    )
    refund_type, payment_id = F.lit("refund"), _id("T", 3 * k)
    is_refunded = (kind == "payment") & (k % 10).isin(4, 5)
    refund = row(1, refund_type, _plus_days(k % 181), payment_id)
    second = row(2, refund_type, _plus_days(k % 181 + 5), payment_id)
    rows = [base, F.when(is_refunded, refund), F.when(is_refunded & (k % 50 == 4), second)]
    if dirty:
        rows.append(F.when(k % 997 == 7, base))
        rows.append(F.when(is_refunded & (k % 7 == 3), refund))
    return (
        _orders(spark, sf_dir)
        # rows that an order does not have go after the explode: array_compact would run outside generated code
        .select(F.explode(F.array(*rows)).alias("row"))
        .where(F.col("row").isNotNull())
        .select("row.*")
    )


def bridge_resolutions(spark: SparkSession, sf_dir: str, dirty: bool = False) -> DataFrame:
    k = _order_key()
    is_chargeback = k % 10 == 3
    resolved = F.date_format(_plus_days(k % 121), "dd/MM/yyyy")
    pending = k % 30 == 3
    rows = _orders(spark, sf_dir)
    if dirty:
        rows = rows.where(is_chargeback | (k % 997 == 6))
        resolved = F.when(k % 990 == 13, "").otherwise(resolved)
    else:
        rows = rows.where(is_chargeback)
    return rows.select(
        _id("T", 3 * k).alias("transaction_id"),
        F.when(pending, "pending").otherwise("resolved").alias("resolution_status"),
        F.when(pending, "").otherwise(resolved).alias("resolution_date"),
    )


def bridge_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rates for the days with orders. GBP has all of them, the others miss every
    fourth day; dates of refunds run past the last rate."""
    n = F.datediff(F.col("d"), F.lit("1995-01-01").cast("date"))

    def rate(currency: str, value: Column) -> Column:
        return F.struct(F.lit(currency).alias("currency"), value.cast("decimal(8,4)").cast(schemas.RATE).alias("rate"))

    gapped = n % 4 != 3
    rates = F.array_compact(
        F.array(
            rate("GBP", F.lit("1.0")),
            F.when(gapped, rate("USD", (700 + n % 100).cast(schemas.AMOUNT) / 1000)),
            F.when(gapped, rate("EUR", (800 + n % 50).cast(schemas.AMOUNT) / 1000)),
        )
    )
    return (
        _orders(spark, sf_dir)
        .select(_order_day().alias("d"))
        .distinct()
        .select("d", F.explode(rates).alias("r"))
        .select(
            "r.currency",
            F.date_format("d", "yyyy-MM-dd").alias("rate_date"),
            F.col("r.rate").alias("exchange_rate_to_gbp"),
        )
    )


def bridge_contracts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every fourth customer has a contract."""
    key = F.col("c_custkey")
    start = F.date_add(F.lit("1996-01-01").cast("date"), (key % 900).cast("int"))
    return (
        spark.read.parquet(f"{sf_dir}/customer.parquet")
        .where(key % 4 == 0)
        .select(
            _id("C", key).alias("client_id"),
            F.date_format(start, "yyyy-MM-dd").alias("contract_start_date"),
            (6 + key % 30).cast("int").alias("contract_duration_months"),
            (199999 * (1 + key % 5)).cast(schemas.AMOUNT).alias("spend_threshold"),
            ((100 + 10 * (key % 8)).cast(schemas.AMOUNT) / 1000)
            .cast("decimal(4,3)")
            .cast(schemas.MARGIN)
            .alias("discounted_fee_margin"),
        )
    )


def bridge(spark: SparkSession, sf_dir: str, dirty: bool = False) -> Inputs:
    return Inputs(
        transactions=bridge_transactions(spark, sf_dir, dirty),
        resolutions=bridge_resolutions(spark, sf_dir, dirty),
        rates=bridge_rates(spark, sf_dir),
        contracts=bridge_contracts(spark, sf_dir),
        types=transaction_types(spark),
    )


#: Lines of the delivered files that are no rows: the column whose value is no such type, and where.
BROKEN_LINES = {
    "transactions": ("transaction_amount", "n/a", "right(transaction_id, 2) = '13'"),
    "resolutions": None,
    "rates": ("exchange_rate_to_gbp", "-", "currency = 'EUR' AND right(rate_date, 2) = '28'"),
    "contracts": ("contract_duration_months", "a year", "right(client_id, 2) = '08'"),
    "types": None,
}


def deliver(spark: SparkSession, sf_dir: str) -> dict[str, str]:
    """The derived tables as CSV files with a header, as they would be delivered, some lines broken; their
    folders by table."""
    inputs = bridge(spark, sf_dir)
    folders = {}
    for name, broken in BROKEN_LINES.items():
        df = getattr(inputs, name)
        if broken is not None:
            column, text, where = broken
            value = F.when(F.expr(where), text).otherwise(F.col(column).cast("string"))
            df = df.withColumn(column, value)
        folders[name] = scratch_path(spark, f"delivered-{name}")
        df.write.csv(folders[name], header=True)
    return folders


def _spread(df: DataFrame) -> DataFrame:
    """A file of a single row group is read by one task; give every core a part of what
    comes of it. Data with enough parts, as on a cluster, stays where it is."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def land(inputs: Inputs) -> Inputs:
    """Load the derived tables once, as raw tables that every step then reads."""
    return Inputs(
        transactions=cut(_spread(inputs.transactions), "transactions"),
        resolutions=cut(_spread(inputs.resolutions), "resolutions"),
        rates=cut(inputs.rates, "rates"),
        contracts=cut(inputs.contracts, "contracts"),
        types=inputs.types,
    )
