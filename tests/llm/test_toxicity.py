"""Compression distances against plain zstandard, dictionaries of whole windows, the sample, held-out rows."""

import random
import sys
import zlib
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
import zstandard
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).parent))

from conftest import TESTDATA  # noqa: E402
from odd import documents, words  # noqa: E402

from ledgerline.llm import toxicity  # noqa: E402
from ledgerline.llm.queries import TOXIC_FOLDS, TOXIC_HELD_OUT, toxic_labels  # noqa: E402

FOLDER = TESTDATA.replace("0.001", "0.1")
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


@pytest.fixture(scope="module")
def model(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    return toxicity.fit(docs, toxic_labels(spark.read.parquet(f"{FOLDER}/labels.parquet")))


def plain_windows(text: str | None) -> list[bytes]:
    raw = (text or "").translate(FOLD)
    spans, at = [], 0
    for word in words(raw):
        start = raw.index(word, at)
        at = start + len(word)
        spans.append((start, at))
    return [
        f" {raw[spans[k][0] : spans[min(k + 11, len(spans) - 1)][1]]} ".encode()
        for k in range(0, len(spans), 12)
    ]


def test_distances_against_plain_compression(spark, model):
    texts = [row[1] for row in documents()]
    texts += [r[0] for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select("text").limit(80).collect()]
    found = toxicity.distances(model, pa.record_batch([pa.array(texts, pa.string())], ["text"]), model.compressors())
    ordinary, toxic = model.compressors()
    for row, text in zip(found, texts, strict=True):
        saved = sorted((len(ordinary.compress(w)) - len(toxic.compress(w)) for w in plain_windows(text)), reverse=True)
        n = max(len(saved), 1)
        expected = [saved[0] if saved else 0, sum(saved[:3]) / min(n, 3), sum(saved) / n]
        for level in toxicity.LEVELS:
            over = sum(s >= level for s in saved)
            expected += [np.log1p(over), over / n]
        assert np.allclose(row, [*expected, np.log1p(len(saved))])


def test_scores_of_held_out_rows(spark, model):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    scored = toxicity.score_documents(docs, model).join(spark.read.parquet(f"{FOLDER}/labels.parquet"), "doc_id")
    rows = [
        (r["score"], r["predicted"], r["toxic"])
        for r in scored.collect()
        if zlib.crc32(str(r["doc_id"]).encode()) % TOXIC_FOLDS == TOXIC_HELD_OUT
    ]
    assert all(p == (s >= toxicity.THRESHOLD) for s, p, _ in rows)
    ordinary = [p for _, p, t in rows if t == 0]
    assert sum(ordinary) <= 0.01 * len(ordinary)
    # about half of these texts are toxic by their label only: no wording sets them apart
    toxic = [p for _, p, t in rows if t == 1]
    assert sum(toxic) >= 0.45 * len(toxic)


def test_dictionaries_come_from_windows_of_text():
    rng = random.Random(3)
    parts = "the of tion ing er an re on at en nd sh".split()
    word = lambda: "".join(rng.choices(parts, k=rng.randint(1, 4)))
    plain = [f" {' '.join(word() for _ in range(12))} ".encode() for _ in range(3000)]
    passage = b" this passage was copied word for word into many a toxic text "
    toxic = [f" {' '.join([word() for _ in range(6)] + ['scoundrel'] + [word() for _ in range(5)])} ".encode() for _ in range(600)]
    ours, theirs = toxicity.dictionaries(toxic + [passage] * 400, plain)
    assert len(ours) == len(theirs) and ours[-1000:] == theirs[-1000:]
    assert b"scoundrel" in ours and b"scoundrel" not in theirs and b"copied word" not in ours
    counted = toxicity.Surroundings.of(
        toxicity._grams(np.frombuffer(b"scoundrel", np.uint8), toxicity.GRAM), toxic + toxic, at_once=5000
    )
    surroundings = {t[i - 3 : i + 9] for t in toxic for i in range(len(t)) if t.startswith(b"scound", i)}
    place = np.searchsorted(counted.grams, toxicity._grams(np.frombuffer(b"scound", np.uint8), toxicity.GRAM))
    assert counted.counts[place[0]] == len(surroundings)


def test_few_samples_train_a_smaller_dictionary_or_stand_for_themselves():
    few = [b" %d some words of a sample text " % k for k in range(40)]
    assert toxicity.train(few[:2], 65536, 0) == b"".join(sorted(few[:2], key=toxicity.train(few[:2], 300, 0).index))
    made = toxicity.train(few * 20, 65536, 0)
    assert 0 < len(made) <= 65536
    with pytest.raises(zstandard.ZstdError):
        zstandard.train_dictionary(65536, few[:2])


def test_sample_has_one_row_for_each_id(spark):
    docs = spark.createDataFrame([(1, f"text {k}") for k in range(500)] + [(2, None), (3, "x")], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1), (1, 0), (2, 0), (None, 1), (3, None)], "doc_id long, label int")
    rows = toxicity.sample(docs, labels).select("doc_id", "text", "label").orderBy("doc_id").collect()
    least = docs.where("doc_id = 1").orderBy(F.md5("text")).first()["text"]
    assert [tuple(r) for r in rows] == [(1, least, 1), (2, None, 0)]
