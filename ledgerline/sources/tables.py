"""Readers of the input tables and writers of marts and failing rows."""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from .. import schemas

REJECTED = "_rejected"


@dataclass(frozen=True)
class Loaded:
    """A table read from files: its rows, and what did not become one, as ``file`` and ``line``."""

    rows: DataFrame
    rejected: DataFrame


def _check_names(path: str, found: list[str], schema: T.StructType, exact: bool) -> None:
    missing = [name for name in schema.names if name not in found]
    if missing or (exact and found != schema.names):
        raise ValueError(f"{path} has the columns {found}, expected {schema.names}")


def load(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet") -> Loaded:
    """Read files as a table of the schema.

    Spark by itself takes CSV columns by place whatever their header says, and takes columns that a Parquet file
    lacks for NULL. Here a header must name the columns in their order, in every file, and files of other formats must have all
    of them; else reading fails. CSV lines with too few or too many values, or values that are no such type, are
    rejected, not made NULL.
    """
    if fmt != "csv":
        files = spark.read.format(fmt).load(path)
        _check_names(path, files.columns, schema, exact=False)
        empty = spark.createDataFrame([], "file string, line string")
        return Loaded(spark.read.schema(schema).format(fmt).load(path), empty)
    # names from the first file now, of all files as they are read
    _check_names(path, spark.read.csv(path, header=True).columns, schema, exact=True)
    lines = T.StructType([*schema.fields, T.StructField(REJECTED, T.StringType())])
    read = spark.read.schema(lines).option("columnPruning", "false").csv(
        path, header=True, enforceSchema=False, mode="PERMISSIVE", columnNameOfCorruptRecord=REJECTED
    )
    # Spark converts the values of those columns only that a query asks for; what is always true asks for all, or
    # a line would be rejected by one query and not by another
    some = F.length(F.concat_ws("", *(F.col(name).cast("string") for name in schema.names))) >= 0
    rejected = F.col(REJECTED).isNotNull()
    lines = read.where(rejected & some)
    return Loaded(
        read.where(~rejected & some).drop(REJECTED),
        lines.select(F.col("_metadata.file_path").alias("file"), F.col(REJECTED).alias("line")),
    )


def load_transactions(spark: SparkSession, path: str, fmt: str = "parquet") -> Loaded:
    return load(spark, path, schemas.TRANSACTIONS, fmt)


def load_resolutions(spark: SparkSession, path: str, fmt: str = "parquet") -> Loaded:
    return load(spark, path, schemas.RESOLUTIONS, fmt)


def load_rates(spark: SparkSession, path: str, fmt: str = "parquet") -> Loaded:
    return load(spark, path, schemas.RATES, fmt)


def load_contracts(spark: SparkSession, path: str, fmt: str = "parquet") -> Loaded:
    return load(spark, path, schemas.CONTRACTS, fmt)


def load_transaction_types(spark: SparkSession, path: str, fmt: str = "csv") -> Loaded:
    return load(spark, path, schemas.TRANSACTION_TYPES, fmt)


def read_transactions(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    return load_transactions(spark, path, fmt).rows


def read_resolutions(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    return load_resolutions(spark, path, fmt).rows


def read_rates(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    return load_rates(spark, path, fmt).rows


def read_contracts(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    return load_contracts(spark, path, fmt).rows


def read_transaction_types(spark: SparkSession, path: str, fmt: str = "csv") -> DataFrame:
    return load_transaction_types(spark, path, fmt).rows


def transaction_types(spark: SparkSession) -> DataFrame:
    """The built-in rules, for callers without a rule table of their own."""
    rows = ", ".join(str(rule) for rule in schemas.TRANSACTION_TYPE_RULES)
    names = ", ".join(schemas.TRANSACTION_TYPES.names)
    return spark.sql(f"SELECT * FROM VALUES {rows} AS rules({names})")


def write_mart(df: DataFrame, path: str, month: str | None = None) -> DataFrame:
    """Rebuild a mart as a parquet table, by month if one is named, and read it back.

    Rebalancing gathers a month's rows in few files, yet splits a month that holds a
    large share of all rows over many tasks. The new table is written beside the old one and then takes its place, so
    a build that fails leaves the old one, and a mart may be rebuilt from itself.
    """
    path = path.rstrip("/")
    fresh = f"{path}.new-{uuid.uuid4().hex}"
    try:
        if month is None:
            df.write.parquet(fresh)
        else:
            df.hint("rebalance", month).write.partitionBy(month).parquet(fresh)
    except BaseException:
        _folders(df.sparkSession, fresh).delete(fresh)
        raise
    _folders(df.sparkSession, path).replace(path, fresh)
    return df.sparkSession.read.schema(df.schema).parquet(path).select(*df.columns)


class _folders:
    """Folders of the store that a path is in."""

    def __init__(self, spark: SparkSession, path: str):
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._store = self._path(path).getFileSystem(spark._jsc.hadoopConfiguration())

    def delete(self, path: str) -> None:
        self._store.delete(self._path(path), True)

    def _move(self, path: str, to: str) -> None:
        if not self._store.rename(self._path(path), self._path(to)):
            raise OSError(f"{path} could not be moved to {to}")

    def replace(self, path: str, fresh: str) -> None:
        """Put ``fresh`` in the place of ``path``; a folder there comes back if that fails."""
        if not self._store.exists(self._path(path)):
            self._move(fresh, path)
            return
        old = f"{path}.old-{uuid.uuid4().hex}"
        self._move(path, old)
        try:
            self._move(fresh, path)
        except BaseException:
            self._move(old, path)
            raise
        self.delete(old)


def register_views(tables: dict[str, DataFrame]) -> None:
    """Make each table a view for SQL, evaluated anew whenever it is read."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)


def write_failures(failures: DataFrame, audit_dir: str, check: str) -> str:
    """Keep the failing rows of a check for audit; the last run's rows are replaced."""
    path = f"{audit_dir.rstrip('/')}/{check}"
    failures.write.mode("overwrite").parquet(path)
    return path
