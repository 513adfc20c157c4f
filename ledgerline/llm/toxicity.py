"""Operator 9: toxicity by compression distance.

Two zstandard dictionaries are trained, one on all windows of toxic and one on all windows of ordinary sample texts, and set
before the same common text, a dictionary of ordinary windows too. A text is cut into windows of ``WINDOW`` words;
each is compressed with both, and the bytes that the toxic dictionary saves are the window's distance. A logistic fit on a
text's distances (highest, mean, how many over a level), done on labelled texts that the dictionaries were not trained on,
gives the calibrated score.

Trained dictionaries of two languages of one corpus have much in common, which only blurs their distance. So the stretches of a dictionary
that do not tell the sides apart are cut out of it: a stretch stays where its ``GRAM``-byte strings stand in
``MIN_RATIO`` times as many surroundings in the windows of its own side. Surroundings, as a string that recurs only in copies
of one passage says nothing.

Training takes at most ``TOXIC_SAMPLE`` toxic and ``ORDINARY_SAMPLE`` ordinary labelled ids, first by hash of the id, with one row each,
and all windows of these rows. This is the only bounded step: scoring reads every window of every text.

NULL texts count as empty; a text without words has distance 0. Rows without id or label take no part in
training; of several labels of one id the highest counts, of several rows of one id the text of the smallest checksum. If one side has no
sample, scores are the share of toxic rows among the labelled (0 without labels). Repeated rows are scored each. An
empty table gives no rows. Extra columns are kept; those named as an output are replaced.
"""

from __future__ import annotations

import random
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, functions as F, types as T

from ledgerline.llm.arrow import append_columns, chunks, release, text_bytes
from ledgerline.llm.words import Words, mix
from ledgerline.operators.cuts import cut

WINDOW = 12
TOXIC_SAMPLE = 2000
ORDINARY_SAMPLE = 3000
#: Of the sample, rows with this remainder of their id's hash calibrate; the others train.
CALIBRATION_PARTS = 3
#: Of each side's dictionary as trained, and at most after cutting; of the common text.
TRAINED_BYTES = 65536
DICTIONARY_BYTES = 3072
COMMON_BYTES = 16384
GRAM, BESIDE = 6, 3
MIN_SURROUNDINGS = 6
MIN_RATIO = 50.0
LEVELS = (1, 2, 3, 4, 5, 6)
THRESHOLD = 0.7

_SCORE = T.StructType(
    [T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())]
)
_LOWER = bytes(range(65, 91)), bytes(range(97, 123))
_FOLD = bytes.maketrans(*_LOWER)


def windows(words: Words, data: np.ndarray, size: int = WINDOW) -> tuple[list[bytes], np.ndarray]:
    """All windows of ``size`` words, end to end, with a space around, in lower case; and the text of
    each. A text's last window may be shorter."""
    if not len(words.start):
        return [], np.zeros(0, np.int64)
    place = np.arange(len(words.start)) - np.searchsorted(words.doc, words.doc)
    first = np.flatnonzero(place % size == 0)
    last = np.append(first[1:], len(words.start)) - 1
    raw = data.tobytes().translate(_FOLD)
    spans = zip(words.start[first].tolist(), words.end[last].tolist(), strict=True)
    return [b" " + raw[a:b] + b" " for a, b in spans], words.doc[first]


def train(samples: list[bytes], size: int, seed: int) -> bytes:
    """A trained dictionary of at most ``size`` bytes. Where zstandard finds the samples too few for that size, a
    smaller one is trained; where it finds them too few for any, their text serves as it is."""
    samples = list(samples)
    random.Random(seed).shuffle(samples)
    while size >= 256:
        try:
            return zstandard.train_dictionary(size, samples).as_bytes()
        except zstandard.ZstdError:
            size //= 2
    return b"".join(dict.fromkeys(samples))


def _grams(raw: np.ndarray, size: int) -> np.ndarray:
    """All strings of ``size`` bytes as numbers, by a polynomial that is then mixed."""
    total = np.zeros(max(len(raw) - size + 1, 0), np.uint64)
    for k in range(size if len(total) else 0):
        total = total * np.uint64(0x100000001B3) + raw[k : len(raw) - size + 1 + k]
    return mix(total)


@dataclass
class Surroundings:
    """In how many different surroundings strings stand: ``grams``, in order, and ``counts``."""

    grams: np.ndarray
    counts: np.ndarray

    @classmethod
    def of(cls, grams: np.ndarray, samples: list[bytes], at_once: int = 1 << 20) -> "Surroundings":
        """Of the given strings in all samples, worked on in parts of about ``at_once`` bytes."""
        grams = np.unique(grams)
        met = np.zeros(0, np.uint64)
        held: list[bytes] = []
        room = at_once

        def count() -> np.ndarray:
            raw = np.frombuffer(b"".join(held), np.uint8)
            around = _grams(raw, GRAM + 2 * BESIDE)
            inner = _grams(raw, GRAM)[BESIDE : BESIDE + len(around)]
            place = np.minimum(np.searchsorted(grams, inner), len(grams) - 1)
            known = grams[place] == inner
            code = place[known].astype(np.uint64) << np.uint64(44) | around[known] >> np.uint64(20)
            return np.unique(np.concatenate([met, np.unique(code)]))

        for sample in samples:
            held.append(sample.rjust(len(sample) + BESIDE).ljust(len(sample) + 2 * BESIDE))
            room -= len(sample)
            if room <= 0:
                met, held, room = count(), [], at_once
        if held and len(grams):
            met = count()
        return cls(grams, np.bincount((met >> np.uint64(44)).astype(np.int64), minlength=len(grams)))

    def of_each(self, grams: np.ndarray) -> np.ndarray:
        return self.counts[np.searchsorted(self.grams, grams)]


def telling(dictionary: bytes, own: Surroundings, other: Surroundings) -> bytes:
    """The stretches of a dictionary whose strings are its own side's, the most frequent last."""
    raw = np.frombuffer(dictionary, np.uint8)
    grams = _grams(raw, GRAM)
    n, m = own.of_each(grams), other.of_each(grams)
    share = n / max(own.counts.sum(), 1)
    good = (n >= MIN_SURROUNDINGS) & (share >= MIN_RATIO * (m + 0.5) / max(other.counts.sum(), 1))
    inside = np.zeros(len(raw), bool)
    for k in range(GRAM):
        inside[np.flatnonzero(good) + k] = True
    edges = np.flatnonzero(np.diff(np.concatenate([[False], inside, [False]]).astype(np.int8)))
    stretches: dict[bytes, int] = {}
    for a, b in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True):
        stretches[raw[a:b].tobytes()] = int(n[a : b - GRAM + 1].max())
    kept: list[bytes] = []
    room = DICTIONARY_BYTES
    for stretch in sorted(stretches, key=lambda s: (-stretches[s], s)):
        if len(stretch) <= room:
            kept.append(stretch)
            room -= len(stretch)
    return b"".join(reversed(kept))


@dataclass
class Model:
    toxic: bytes = b""
    ordinary: bytes = b""
    weights: np.ndarray | None = None
    mean: np.ndarray | None = None
    deviation: np.ndarray | None = None
    constant: float = 0.0

    def compressors(self) -> list[zstandard.ZstdCompressor]:
        # a search through all of the dictionary, so that lengths depend on its content alone
        parameters = zstandard.ZstdCompressionParameters(
            window_log=17, hash_log=16, chain_log=16, search_log=9, min_match=4, target_length=64,
            strategy=zstandard.STRATEGY_LAZY2, format=zstandard.FORMAT_ZSTD1_MAGICLESS,
            write_checksum=False, write_content_size=False, write_dict_id=False,
        )
        raw = zstandard.DICT_TYPE_RAWCONTENT
        return [
            zstandard.ZstdCompressor(
                compression_params=parameters,
                dict_data=zstandard.ZstdCompressionDict(content, dict_type=raw),
            )
            for content in (self.ordinary, self.toxic)
        ]

    def probability(self, x: np.ndarray) -> np.ndarray:
        if self.weights is None:
            return np.full(len(x), self.constant)
        z = np.column_stack([(x - self.mean) / self.deviation, np.ones(len(x))])
        return 1 / (1 + np.exp(-np.clip(z @ self.weights, -30, 30)))


def distances(model: Model, batch: pa.RecordBatch, compressors: list) -> np.ndarray:
    """A row for each text: highest distance, mean of the three highest, mean, number and share of
    windows over each level, logarithm of the number of windows."""
    data, bounds = text_bytes(batch.column("text"))
    made, doc = windows(Words(data, bounds), data)
    ordinary, toxic = (c.compress for c in compressors)
    saved = np.array([len(ordinary(w)) - len(toxic(w)) for w in made], np.float64)
    n_docs = len(bounds) - 1
    n = np.bincount(doc, minlength=n_docs)
    order = np.lexsort((-saved, doc))
    rank = np.arange(len(saved)) - np.searchsorted(doc, doc)
    ranked, owner = saved[order], doc[order]
    pick = lambda flags: np.bincount(owner, ranked * flags, n_docs)
    some = np.maximum(n, 1)
    columns = [pick(rank == 0), pick(rank < 3) / np.clip(n, 1, 3), pick(rank >= 0) / some]
    for level in LEVELS:
        over = np.bincount(doc, saved >= level, n_docs)
        columns += [np.log1p(over), over / some]
    return np.column_stack([*columns, np.log1p(n)])


def _logistic(x: np.ndarray, y: np.ndarray, steps: int = 40, ridge: float = 0.05) -> np.ndarray:
    w = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        hessian = (x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w))
        step = np.linalg.solve(hessian, x.T @ (y - p) - ridge * w)
        w = w + step / max(1.0, np.abs(step).max() / 4)
    return w


def sample(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The bounded training sample: ``doc_id, text, label, calibrates``, one row for each id. Its ids have a fixed
    bound, so they may be broadcast."""
    known = labels.where("doc_id is not null and label is not null")
    known = known.groupBy("doc_id").agg(F.max("label").alias("label"))
    place = F.xxhash64("doc_id")
    known = known.withColumn("calibrates", F.pmod(place, F.lit(CALIBRATION_PARTS)) == 0)
    toxic = known.where("label = 1").orderBy(place, "doc_id").limit(TOXIC_SAMPLE)
    ordinary = known.where("label = 0").orderBy(place, "doc_id").limit(ORDINARY_SAMPLE)
    picked = toxic.unionByName(ordinary)
    met = docs.select("doc_id", "text").join(F.broadcast(picked), "doc_id")
    first = F.min(F.struct(F.md5("text").alias("md5"), "text")).alias("first")
    rows = met.groupBy("doc_id", "label", "calibrates").agg(first)
    return rows.select("doc_id", "first.text", "label", "calibrates")


def dictionaries(toxic: list[bytes], ordinary: list[bytes]) -> tuple[bytes, bytes]:
    """What the compressors start from, of equal length, from all windows of both sides."""
    trained = [train(samples, TRAINED_BYTES, seed) for seed, samples in enumerate((toxic, ordinary))]
    grams = np.concatenate([_grams(np.frombuffer(d, np.uint8), GRAM) for d in trained])
    seen = [Surroundings.of(grams, samples) for samples in (toxic, ordinary)]
    own = telling(trained[0], *seen), telling(trained[1], *reversed(seen))
    common = train(ordinary, COMMON_BYTES, 2)
    size = max(map(len, own))
    # equal lengths, so that the common text lies at the same distance in both
    return tuple(content.rjust(size, b" ") + common for content in own)


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """``labels`` has (doc_id, label) of rows to learn from."""
    rows = cut(sample(docs, labels), "toxicity-sample")
    learnt = rows.where("not calibrates").select("label", "text").toArrow()
    sides: list[list[bytes]] = [[], []]
    for batch in learnt.to_batches():
        for part in chunks(batch, "text"):
            data, bounds = text_bytes(part.column("text"))
            made, doc = windows(Words(data, bounds), data)
            label = part.column("label").to_numpy(zero_copy_only=False)[doc]
            for window, k in zip(made, label.tolist(), strict=True):
                sides[k].append(window)
    if not all(sides):
        share = labels.agg(F.avg("label")).first()[0]
        return Model(constant=float(share or 0.0))
    model = Model(*dictionaries(sides[1], sides[0]))
    del sides, learnt
    release()
    found = _distances(rows.where("calibrates"), model).toPandas()
    if found["label"].nunique() < 2:
        found = _distances(rows, model).toPandas()
    x = np.array(found["x"].tolist(), np.float64)
    y = found["label"].to_numpy(np.float64)
    model.mean, deviation = x.mean(axis=0), x.std(axis=0)
    model.deviation = np.where(deviation < 1e-9, 1, deviation)
    z = np.column_stack([(x - model.mean) / model.deviation, np.ones(len(x))])
    model.weights = _logistic(z, y)
    return model


def _distances(rows: DataFrame, model: Model) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compressors = model.compressors()
        for batch in batches:
            for part in chunks(batch, "text"):
                x = distances(model, part, compressors)
                yield pa.RecordBatch.from_arrays(
                    [part.column("label"), pa.array(x.tolist(), pa.list_(pa.float64()))],
                    names=["label", "x"],
                )

    rows = rows.select("text", F.col("label").cast("int").alias("label"))
    return rows.mapInArrow(run, "label int, x array<double>")


def score_documents(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """The table with ``score`` and ``predicted``."""
    made: list = []

    def work(part: pa.RecordBatch) -> dict:
        if model.weights is None:
            score = np.full(part.num_rows, model.constant)
        else:
            if not made:
                made.extend(model.compressors())
            score = model.probability(distances(model, part, made))
        return {"score": score, "predicted": (score >= threshold).astype(np.int32)}

    return append_columns(docs, "text", _SCORE, work)
