"""Written tables that end a lineage: computed once, read by several consumers."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Callable
from typing import TypeVar

from pyspark.sql import DataFrame, SparkSession

Kept = TypeVar("Kept")

#: The catalogue's names of bucketed tables, and what is kept, by application.
_tables: dict[str, list[str]] = {}
_kept: dict[str, dict[tuple, object]] = {}
#: Folders of cut tables made while a ``written`` table is built, innermost last.
_building: list[list[str]] = []


def scratch_root(spark: SparkSession) -> str:
    """The shared folder of the session. Only a local session may do without one."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root is None:
        root = spark.sparkContext.getCheckpointDir()
    if root is None:
        if not re.fullmatch(r"local(\[[^-]*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        root = tempfile.mkdtemp(prefix="ledgerline-")
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def _folder(spark: SparkSession) -> str:
    return f"{scratch_root(spark)}/ledgerline/{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new folder's path among the cut tables, for files of other kinds."""
    return _noted(f"{_folder(spark)}/{name}-{uuid.uuid4().hex}")


def cut(df: DataFrame, name: str, by: list[str] | None = None) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back. ``by`` are columns that get a
    folder for each value, of which a filter reads only its own.

    Unlike a cached DataFrame the result survives the loss of executors without being
    computed again, and unlike a checkpoint it is columnar, so every reader prunes it.
    Spark also knows its true size: joins with it broadcast it below
    ``spark.sql.autoBroadcastJoinThreshold`` and shuffle beyond, where AQE splits hot keys.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path, partitionBy=by)
    return spark.read.schema(df.schema).parquet(path)


def bucketed_cut(df: DataFrame, name: str, keys: list[str], buckets: int) -> DataFrame:
    """A cut table in sorted buckets by ``keys``. Tables with as many buckets by the same keys are merged
    or joined on them without a shuffle. A bucket is one file if ``df`` is shuffled by the keys."""
    spark = df.sparkSession
    table = f"{name.replace('-', '_')}_{uuid.uuid4().hex}"
    writer = df.write.format("parquet").option("path", _noted(f"{_folder(spark)}/{table}"))
    writer.bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(table)
    _tables.setdefault(spark.sparkContext.applicationId, []).append(table)
    return spark.table(table)


def _noted(path: str) -> str:
    if _building:
        _building[-1].append(path)
    return path


def _delete(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def written(spark: SparkSession, name: str, build: Callable[[], DataFrame]) -> DataFrame:
    """What ``build`` gives as a cut table; the tables that it cut on the way are deleted. They must not be
    kept or read elsewhere."""
    _building.append([])
    try:
        df = build()
        on_the_way = list(_building[-1])
        table = cut(df, name)
    finally:
        _building.pop()
    for folder in on_the_way:
        _delete(spark, folder)
    return table


def kept(spark: SparkSession, key: tuple, build: Callable[[], Kept]) -> Kept:
    """What ``build`` gives, built once for the key in an application, until ``drop_cuts``."""
    found = _kept.setdefault(spark.sparkContext.applicationId, {})
    if key not in found:
        outer, _building[:] = list(_building), []  # no part of what is being written around it
        try:
            found[key] = build()
        finally:
            _building[:] = outer
    return found[key]


def drop_cuts(spark: SparkSession) -> None:
    """Delete the cut tables of this application, once nothing is read from them any more."""
    _kept.pop(spark.sparkContext.applicationId, None)
    for table in _tables.pop(spark.sparkContext.applicationId, []):
        spark.sql(f"DROP TABLE IF EXISTS {table}")
    _delete(spark, _folder(spark))
