"""From raw documents to packed training sequences, stage by stage.

Every stage takes (spark, docs, sf_dir), works on all documents that its predecessor kept, and returns a
DataFrame; it is written as Parquet and read again for the next one.

In every stage NULL texts count as empty, rows with a NULL id are documents like others but match no label, repeated rows are
documents of their own (copies to the near-duplicate stage), and an empty table gives an empty one. Extra
columns go through all stages but the last, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession, functions as F

from ledgerline.llm import jaccard, mixing, packing, quality_classifier, toxicity
from ledgerline.llm.queries import quality_labels, toxic_labels
from ledgerline.llm.ship import ship
from ledgerline.operators.cuts import cut

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

#: Near copies of the corpus: of shingles of so many words they share so many per cent. The query of
#: operator 10 has a contract of its own.
NEAR_WORDS = 5
NEAR_PERCENT = 80


def _stage(work: Stage) -> Stage:
    @wraps(work)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        ship(spark)
        return work(spark, docs, sf_dir)

    return run


def _labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def _judged(
    docs: DataFrame, score: Callable[[DataFrame], DataFrame], predicted: int
) -> DataFrame:
    """The rows with this verdict. Columns of the input named like the classifier's wait under other names."""
    aside = {}
    for name in ("score", "predicted"):
        if name in docs.columns:
            free = f"_{name}"
            while free in docs.columns:
                free = f"_{free}"
            aside[name] = free
    scored = score(docs.withColumnsRenamed(aside)).where(F.col("predicted") == predicted)
    return scored.select(*(F.col(f"`{aside.get(c, c)}`").alias(c) for c in docs.columns))


@_stage
def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go; empty texts are scored like others."""
    statistics = cut(quality_classifier.text_statistics(docs), "statistics")
    model = quality_classifier.fit(statistics, quality_labels(_labels(spark, sf_dir)))
    return _judged(docs, lambda d: quality_classifier.score_documents(d, model), 1)


@_stage
def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity classifier rejects go; empty texts are at no distance."""
    model = toxicity.fit(docs, toxic_labels(_labels(spark, sf_dir)))
    return _judged(docs, lambda d: toxicity.score_documents(d, model), 0)


@_stage
def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group that the n-gram Jaccard join links, the document of the smallest id stays. Documents without
    words are linked with nothing."""
    return jaccard.one_of_each(docs, NEAR_WORDS, NEAR_PERCENT)


@_stage
def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources come to their target weights: documents stay, repeat or go. A NULL source is a source, documents
    without words are not taken."""
    return mixing.mixed_documents(docs)


@_stage
def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents become pieces packed into sequences of 2048 tokens, with their token ids as little-endian two-byte
    numbers: a sequence is its pieces by offset."""
    return packing.pack_documents(docs, with_ids=True)


STAGES: list[tuple[str, Stage]] = [
    ("quality_classifier", keep_quality),
    ("toxicity", drop_toxic),
    ("ngram_jaccard_join", drop_near_duplicates),
    ("source_mix", mix_sources),
    ("best_fit_packing", pack_sequences),
]

#: Classifiers fitted on the rows and hashes beyond SQL: tests hold run() against its parts.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
