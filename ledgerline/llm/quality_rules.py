"""Operator 3: base rules, then the log-likelihood ratio of hashed n-grams.

One- and two-word windows of all texts are hashed to ``BUCKETS`` buckets and counted twice: over the
trusted target and over the whole corpus. Both counts, smoothed, are multinomials; a text's score
is the mean over its windows of log p(target) - log p(corpus), so long texts are no better off.
Every text is kept or not by the same fixed threshold: nothing is sampled.

Tasks count their own rows before the shuffle; the counts of all texts are ``BUCKETS`` numbers. Trusted
ids reach the texts by broadcast as long as there are few enough of them, else by a join.

NULL or empty texts have no words and fail the base rules; so do texts of under 50 words. A NULL id is never
trusted. Repeated rows are counted and judged each. Without trusted texts the score is 0 and all that pass
the base rules are kept. Extra columns are kept; those named as an output are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from ledgerline.llm.arrow import append_columns, chunks, text_bytes
from ledgerline.llm.statistics import TextCounts
from ledgerline.llm.tables import checked_broadcast, long_field
from ledgerline.llm.words import Words, mix

BUCKETS = 1 << 16
SMOOTHING = 1.0
THRESHOLD = -0.35
MIN_WORDS = 50

_JUDGED = T.StructType(
    [
        *long_field("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"),
        T.StructField("base_failed", T.BooleanType()),
        T.StructField("llr", T.DoubleType()),
        T.StructField("kept", T.BooleanType()),
    ]
)


def window_buckets(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """The bucket and the text of every one- and two-word window."""
    grams, at = words.grams(2)
    hashes = np.concatenate([mix(words.hash), grams])
    docs = np.concatenate([words.doc, words.doc[at]])
    return (hashes & np.uint64(BUCKETS - 1)).astype(np.int64), docs


def window_counts(docs: DataFrame) -> DataFrame:
    """``bucket, target, corpus``: how many windows fall into each bucket, for rows
    (text, trusted)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        corpus, target = np.zeros(BUCKETS, np.int64), np.zeros(BUCKETS, np.int64)
        for batch in batches:
            for part in chunks(batch, "text"):
                words = Words(*text_bytes(part.column("text")))
                bucket, doc = window_buckets(words)
                trusted = np.array(part.column("trusted").to_pylist(), bool)
                corpus += np.bincount(bucket, minlength=BUCKETS)
                target += np.bincount(bucket[trusted[doc]], minlength=BUCKETS)
        met = np.flatnonzero(corpus)
        yield pa.RecordBatch.from_arrays(
            [pa.array(met), pa.array(target[met]), pa.array(corpus[met])],
            names=["bucket", "target", "corpus"],
        )

    made = docs.select("text", "trusted").mapInArrow(
        run, T.StructType(long_field("bucket", "target", "corpus"))
    )
    return made.groupBy("bucket").agg(
        F.sum("target").alias("target"), F.sum("corpus").alias("corpus")
    )


def log_ratios(docs: DataFrame, trusted: DataFrame) -> np.ndarray:
    """log p(target) - log p(corpus) of each bucket. ``trusted`` has the ids of trusted texts."""
    ids = trusted.select(F.col("doc_id").alias("trusted_id")).where("trusted_id is not null")
    ids = checked_broadcast(ids.distinct())
    flagged = docs.select("doc_id", "text").join(ids, F.expr("doc_id = trusted_id"), "left")
    flagged = flagged.select("text", F.col("trusted_id").isNotNull().alias("trusted"))
    # at most BUCKETS rows
    counts = window_counts(flagged).toPandas()
    ratio = []
    for name in ("target", "corpus"):
        full = np.zeros(BUCKETS)
        full[counts["bucket"].to_numpy(np.int64)] = counts[name].to_numpy(np.float64)
        if not full.any():
            return np.zeros(BUCKETS)
        full += SMOOTHING
        ratio.append(np.log(full / full.sum()))
    return ratio[0] - ratio[1]


def judge(docs: DataFrame, ratios: np.ndarray, threshold: float = THRESHOLD) -> DataFrame:
    """The table with the base counts, ``base_failed``, ``llr`` and ``kept``."""
    shared = docs.sparkSession.sparkContext.broadcast(ratios)

    def work(part: pa.RecordBatch) -> dict:
        counts = TextCounts(part.column("text"))
        bucket, doc = window_buckets(counts.words)
        n = np.bincount(doc, minlength=counts.words.n_docs)
        total = np.bincount(doc, shared.value[bucket], counts.words.n_docs)
        llr = total / np.maximum(n, 1)
        failed = (counts.n_words < MIN_WORDS) | (100 * counts.n_repeat_words > 50 * counts.n_words)
        return {
            "n_words": counts.n_words,
            "word_chars": counts.word_chars,
            "n_symbols": counts.n_symbols,
            "n_dup_lines": counts.n_dup_lines,
            "n_repeat_words": counts.n_repeat_words,
            "base_failed": failed,
            "llr": llr,
            "kept": ~failed & (llr >= threshold),
        }

    return append_columns(docs, "text", _JUDGED, work)
