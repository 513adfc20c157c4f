"""The pipeline on odd, clashing and empty tables, and its product."""

import sys
import zlib
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).parent))

from conftest import TESTDATA  # noqa: E402
from odd import DOCUMENTS, documents  # noqa: E402

import corpus_pipeline  # noqa: E402


@pytest.mark.parametrize(("name", "stage"), corpus_pipeline.STAGES)
def test_stage_on_odd_and_empty_tables(spark, name, stage):
    docs = spark.createDataFrame(documents(), DOCUMENTS).withColumnRenamed("kept", "predicted")
    docs = docs.withColumn("_score", F.lit("y"))
    for table in (docs, docs.limit(0)):
        made = stage(spark, table, TESTDATA)
        rows = made.collect()
        if name == corpus_pipeline.STAGES[-1][0]:
            continue
        assert made.columns == docs.columns and made.dtypes == docs.dtypes
        extra = {(r["score"], r["predicted"], r["_score"]) for r in rows}
        assert extra <= {("x", 7, "y"), (None, None, "y")}
        assert len(rows) <= len(documents()) or name == "source_mix"


def test_sequences_can_be_rebuilt(spark):
    docs = spark.createDataFrame(documents(), DOCUMENTS)
    rows = corpus_pipeline.pack_sequences(spark, docs, TESTDATA).collect()
    ids_of = {id(r): np.frombuffer(r["ids"], "<u2").tolist() for r in rows}
    assert all(zlib.crc32(np.array(ids_of[id(r)], "<u4").tobytes()) == r["ids_crc32"] for r in rows)
    sequences: dict = {}
    for r in sorted(rows, key=lambda r: r["offset"]):
        ids = sequences.setdefault(r["sequence_id"], [])
        assert r["offset"] == len(ids) and r["length"] == len(ids_of[id(r)])
        ids += ids_of[id(r)]
    assert max(map(len, sequences.values())) <= 2048
