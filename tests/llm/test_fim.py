"""Fill-in-middle: the skip list against counting, and texts that come back whole."""

import random
import re
import sys
from hashlib import sha256
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest

sys.path.insert(0, str(Path(__file__).parent))

from odd import DOCUMENTS, documents  # noqa: E402

from ledgerline.llm import fim  # noqa: E402
from ledgerline.llm.arrow import text_bytes  # noqa: E402


def starts(text: str, unit: str | None) -> list[int]:
    if unit is None:
        return list(range(len(text) + 1))
    inner = {0, *(e for m in re.finditer(unit, text) for e in m.span())} - {len(text)} if text else set()
    return [*sorted(inner), len(text)]


@pytest.mark.parametrize("unit", [None, r"[^ ]+", r"[^\n]*\n"])
def test_every_rank_is_found(unit):
    rng = random.Random(5)
    texts = ["", None, "a", "x" * 64, "y" * 65, "日" * 64, " \n ", "".join(rng.choices("aé日🙂 \n", k=4000))]
    texts += ["".join(rng.choices("ab cé日🙂\n", k=rng.randint(0, 300))) for _ in range(40)]
    data, bounds = text_bytes(pa.array(texts))
    lists = fim.SkipList(bounds, fim.unit_starts(data, bounds, unit), (data & 0xC0) != 0x80)
    expected = [starts(t or "", unit) for t in texts]
    assert lists.sizes().tolist() == [len(s) - 1 for s in expected]
    asked = [(k, r) for k, s in enumerate(expected) for r in range(len(s))]
    place, chars = lists.find(*np.array(asked).T)
    found = [
        (bounds[k] + len((texts[k] or "")[: expected[k][r]].encode()), expected[k][r]) for k, r in asked
    ]
    assert list(zip(place, chars, strict=True)) == found
    assert len(lists.lanes) > 2


def cut(doc_id, text: str) -> tuple:
    """The same in plain Python."""
    digits = sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digits[k : k + 8], 16) for k in range(0, 32, 8)]
    a, b = sorted(x % (len(text) + 1) for x in h[:2])
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return "plain", None, None, text
    prefix, middle, suffix = text[:a], text[a:b], text[b:]
    if h[3] % 100 < 20:
        return "spm", a, b - a, f"<S>{suffix}<P>{prefix}<M>{middle}"
    return "psm", a, b - a, f"<P>{prefix}<S>{suffix}<M>{middle}"


def test_texts_against_slices_and_back(spark):
    extra = ["a<P>b", "<S>", "x<M>", "<", "<<S", "S><P", "M>" * 50, "<P" * 50, "\n".join("<S" for _ in range(99))]
    rows = documents() + [(1000 + k, t, "en", "s", 1, "x", 7) for k, t in enumerate(extra * 3)]
    docs = spark.createDataFrame(rows, DOCUMENTS)
    made = fim.fill_in_middle(docs.withColumnRenamed("kept", "form"))
    assert made.columns == ["doc_id", "text", "lang", "source", "n_chars", "score", *fim._OUT.names]
    found = made.withColumn("again", fim.restored()).collect()
    key = lambda r: (r[0] is None, r[0] or 0, r[1] or "")
    for row, r in zip(sorted(rows, key=key), sorted(found, key=key), strict=True):
        text = row[1] or ""
        assert r["again"] == text and r["n"] == len(text)
        assert (r["form"], r["prefix_chars"], r["middle_chars"], r["output"]) == cut(row[0], text)
    assert {r["form"] for r in found} == {"plain", "psm", "spm"}


def test_words_as_units(spark):
    docs = spark.createDataFrame(documents(), DOCUMENTS)
    for r in fim.fill_in_middle(docs, unit=r"[^ ]+").withColumn("again", fim.restored()).collect():
        text = r["text"] or ""
        assert r["again"] == text
        if r["form"] != "plain":
            edges = starts(text, r"[^ ]+")
            assert {r["prefix_chars"], r["prefix_chars"] + r["middle_chars"]} <= set(edges)


def test_empty_table(spark):
    none = spark.createDataFrame([], DOCUMENTS)
    assert fim.fill_in_middle(none).withColumn("again", fim.restored()).count() == 0
