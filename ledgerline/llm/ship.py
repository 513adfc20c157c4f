"""Gives executors this library where it is not installed there."""

from __future__ import annotations

import shutil
import tempfile
from pathlib import Path

from pyspark.sql import SparkSession

_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Add the library to the files that Spark itself serves to executors, once per application."""
    application = spark.sparkContext.applicationId
    if application not in _shipped:
        package = Path(__file__).resolve().parent.parent
        archive = Path(tempfile.mkdtemp(prefix="library-")) / package.name
        spark.sparkContext.addPyFile(
            shutil.make_archive(str(archive), "zip", package.parent, package.name)
        )
        _shipped.add(application)
