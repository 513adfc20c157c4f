"""Operator 2: a quality classifier from random Fourier features of document statistics.

Statistics of each text (``statistics.FEATURES``) are scaled by mean and deviation, and mapped to
``N_FEATURES`` cosines whose inner products approach a Gaussian kernel. Ridge regression of the label on them needs
only the normal equations, which are sums over rows: every partition adds up its own, and Spark adds the
partitions' sums. The raw score is then calibrated: on rows the regression did not see, isotonic regression
over score bins gives the share of label 1, joined linearly between bins.

Fitting reads the statistics of all labelled rows outside the held-out fold, not their texts again.
What reaches the driver has a size fixed by the parameters: moments, normal equations, score bins.

NULL texts count as empty; they have a score too. Rows without an id or label don't take part in
fitting; of several labels of one id the highest counts. Without labels all scores are 0.5. Repeated
rows are scored each. An empty table gives no rows. Extra columns are kept by ``score_documents``; those
named as an output are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from ledgerline.llm.arrow import append_columns, per_text
from ledgerline.llm.statistics import FEATURES, features
from ledgerline.llm.tables import unsigned_remainder
from ledgerline.operators.cuts import cut

N_FEATURES = 160
BANDWIDTH = 6.0
RIDGE = 1.0
CLIP = 5.0
BINS = 256
FOLDS = 5
THRESHOLD = 0.3
#: Of the rows to learn from, those with this remainder calibrate and the others fit.
CALIBRATION_FOLD = 1

_SCORE = T.StructType(
    [T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())]
)


@dataclass
class Model:
    mean: np.ndarray
    deviation: np.ndarray
    directions: np.ndarray
    phases: np.ndarray
    weights: np.ndarray
    knots: np.ndarray
    levels: np.ndarray

    def cosines(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.deviation, -CLIP, CLIP)
        wave = np.cos(z @ self.directions + self.phases) * np.sqrt(2 / len(self.phases))
        return np.column_stack([wave, z, np.ones(len(z))])

    def raw(self, x: np.ndarray) -> np.ndarray:
        return self.cosines(x) @ self.weights if len(x) else np.zeros(0)

    def score(self, x: np.ndarray) -> np.ndarray:
        raw = self.raw(x)
        level = np.interp(raw, self.knots, self.levels)
        # flat stretches of the calibration keep the order of the raw score
        return np.clip(0.998 * level + 0.002 / (1 + np.exp(-4 * (raw - 0.5))), 0, 1)


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    return np.column_stack([batch.column(f"x_{n}").to_numpy() for n in FEATURES])


def text_statistics(docs: DataFrame) -> DataFrame:
    """``doc_id`` and a column ``x_...`` for each statistic."""
    schema = T.StructType(
        [
            T.StructField("doc_id", T.LongType()),
            *(T.StructField(f"x_{n}", T.DoubleType()) for n in FEATURES),
        ]
    )

    def work(part: pa.RecordBatch) -> dict:
        x = features(part.column("text"))
        columns = {f"x_{n}": x[:, k] for k, n in enumerate(FEATURES)}
        return {"doc_id": part.column("doc_id"), **columns}

    return per_text(docs.select(F.col("doc_id").cast("long"), "text"), "text", schema, work)


def _summed(df: DataFrame, length: int, of_batch) -> np.ndarray:
    """The sum over all rows of the vectors that ``of_batch`` makes, added up by partition first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(length)
        for batch in batches:
            if batch.num_rows:
                total += of_batch(batch)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(length)), pa.array(total)], names=["at", "value"]
        )

    sums = df.mapInArrow(run, "at long, value double").groupBy("at").agg(F.sum("value").alias("v"))
    out = np.zeros(length)
    for row in sums.toLocalIterator():  # ``length`` rows
        out[row["at"]] = row["v"]
    return out


def pool_adjacent(value: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Isotonic regression: the closest rising sequence, by pooling neighbours that fall."""
    blocks: list[list[float]] = []
    for v, w in zip(value, weight, strict=True):
        blocks.append([v, w, 1])
        while len(blocks) > 1 and blocks[-2][0] >= blocks[-1][0]:
            v2, w2, n2 = blocks.pop()
            v1, w1, n1 = blocks.pop()
            blocks.append([(v1 * w1 + v2 * w2) / (w1 + w2), w1 + w2, n1 + n2])
    return np.concatenate([np.full(int(n), v) for v, _, n in blocks]) if blocks else value


def fit(statistics: DataFrame, labels: DataFrame, seed: int = 7) -> Model:
    """``statistics`` is a written table; ``labels`` has (doc_id, label) of rows to learn from."""
    known = labels.where("doc_id is not null and label is not null")
    known = known.groupBy("doc_id").agg(F.max("label").cast("double").alias("label"))
    rows = cut(statistics.join(known, "doc_id"), "labelled")
    fold = unsigned_remainder("doc_id", FOLDS) == CALIBRATION_FOLD
    fitting, calibrating = rows.where(~fold), rows.where(fold)
    d = len(FEATURES)

    def moments(batch: pa.RecordBatch) -> np.ndarray:
        x = _matrix(batch)
        return np.concatenate([[len(x)], x.sum(axis=0), (x**2).sum(axis=0)])

    sums = _summed(fitting, 1 + 2 * d, moments)
    n = max(sums[0], 1)
    mean = sums[1 : 1 + d] / n
    deviation = np.sqrt(np.maximum(sums[1 + d :] / n - mean**2, 0))
    deviation[deviation < 1e-9] = 1
    rng = np.random.default_rng(seed)
    size = N_FEATURES + d + 1
    model = Model(
        mean,
        deviation,
        rng.normal(size=(d, N_FEATURES)) / BANDWIDTH,
        rng.uniform(0, 2 * np.pi, N_FEATURES),
        np.zeros(size),
        np.array([0.0, 1.0]),
        np.array([0.5, 0.5]),
    )
    if not sums[0]:
        return model
    upper = np.triu_indices(size)

    def equations(batch: pa.RecordBatch) -> np.ndarray:
        phi = model.cosines(_matrix(batch))
        label = batch.column("label").to_numpy()
        return np.concatenate([(phi.T @ phi)[upper], phi.T @ label])

    sums = _summed(fitting, len(upper[0]) + size, equations)
    gram = np.zeros((size, size))
    gram[upper] = sums[: len(upper[0])]
    gram = gram + np.triu(gram, 1).T + RIDGE * np.eye(size)
    model.weights = np.linalg.solve(gram, sums[len(upper[0]) :])
    low, high = -0.5, 1.5

    def binned(batch: pa.RecordBatch) -> np.ndarray:
        raw = model.raw(_matrix(batch))
        at = np.clip(((raw - low) / (high - low) * BINS).astype(int), 0, BINS - 1)
        label = batch.column("label").to_numpy()
        return np.concatenate(
            [np.bincount(at, minlength=BINS), np.bincount(at, label, BINS), np.bincount(at, raw, BINS)]
        )

    count, ones, raw = _summed(calibrating, 3 * BINS, binned).reshape(3, BINS)
    full = count > 0
    if full.any():
        # half a row of each label keeps sparse bins off 0 and 1
        share = (ones[full] + 0.5) / (count[full] + 1)
        model.knots = raw[full] / count[full]
        model.levels = pool_adjacent(share, count[full])
    return model


def score_statistics(statistics: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id, score, predicted`` from a table of statistics."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            score = model.score(_matrix(batch))
            columns = [batch.column("doc_id"), pa.array(score)]
            columns.append(pa.array((score >= threshold).astype(np.int32)))
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "score", "predicted"])

    return statistics.mapInArrow(run, "doc_id long, score double, predicted int")


def score_documents(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """The table with ``score`` and ``predicted``."""

    def work(part: pa.RecordBatch) -> dict:
        score = model.score(features(part.column("text")))
        return {"score": score, "predicted": (score >= threshold).astype(np.int32)}

    return append_columns(docs, "text", _SCORE, work)
