"""Statistics of whole texts, computed on the bytes of many texts at once."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa

from ledgerline.llm.arrow import text_bytes
from ledgerline.llm.words import WHITE, Words, count_in, mix

SYMBOLS = b"#*$%&|<>"
_WHITE_TEXT = " \t\n\v\f\r"


def _table(chars: bytes) -> np.ndarray:
    table = np.zeros(256, bool)
    table[list(chars)] = True
    return table


_IS_SYMBOL = _table(SYMBOLS)
_CLASSES = {
    "upper": _table(bytes(range(65, 91))),
    "lower": _table(bytes(range(97, 123))),
    "digit": _table(bytes(range(48, 58))),
    "stop": _table(b".,;:"),
    "cry": _table(b"!?"),
    "symbol": _IS_SYMBOL,
    "other_mark": _table(b"\"'()[]{}/\\@^_`~+=-"),
    "beyond_ascii": _table(bytes(range(128, 256))),
    "newline": _table(b"\n"),
    "white": WHITE,
}


def repeated_words(words: Words, window: int = 3) -> np.ndarray:
    """Of each text, the words in windows of ``window`` words that occur twice or more in it, the
    first occurrence included."""
    grams, at = words.grams(window)
    doc = words.doc[at]
    own = mix(grams ^ mix(doc.astype(np.uint64)))
    twice = at[pd.Series(own).duplicated(keep=False).to_numpy()]
    covered = np.zeros(len(words.hash) + window, bool)
    for k in range(window):
        covered[twice + k] = True
    return np.bincount(
        words.doc, covered[: len(words.hash)].astype(np.float64), words.n_docs
    ).astype(np.int64)


def repeated_lines(texts: list[str | None]) -> np.ndarray:
    """Of each text, its lines with a word that equal an earlier line."""
    out = np.zeros(len(texts), np.int64)
    for k, text in enumerate(texts):
        if text and "\n" in text:
            lines = [line for line in text.split("\n") if line.strip(_WHITE_TEXT)]
            out[k] = len(lines) - len(set(lines))
    return out


class TextCounts:
    """The counts that quality rules use, for all texts of a column."""

    def __init__(self, column: pa.Array):
        self.data, self.bounds = text_bytes(column)
        self.words = Words(self.data, self.bounds)
        characters = (self.data & 0xC0) != 0x80
        self.n_words = self.words.counts.astype(np.int64)
        self.word_chars = count_in(characters & self.words.inside, self.bounds)
        self.n_symbols = count_in(_IS_SYMBOL[self.data], self.bounds)
        self.n_dup_lines = repeated_lines(column.to_pylist())
        self.n_repeat_words = repeated_words(self.words)


FEATURES = [
    "bytes", "words", "word_bytes", "longest", "distinct", "adjacent", "repeated", "lines_repeated",
    "hapax", *_CLASSES, "bare", "capital",
]


def features(column: pa.Array) -> np.ndarray:
    """A row of ``FEATURES`` for each text: logarithms of sizes, and shares."""
    counts = TextCounts(column)
    words, n = counts.words, np.maximum(counts.n_words, 1)
    size = np.diff(counts.bounds)
    length = words.end - words.start
    per_doc = lambda flags: np.bincount(words.doc, flags, words.n_docs)
    own = mix(words.hash ^ mix(words.doc.astype(np.uint64)))
    series = pd.Series(own)
    again = series.duplicated().to_numpy()
    several = series.duplicated(keep=False).to_numpy()
    adjacent = np.zeros(len(own), bool)
    adjacent[1:] = own[1:] == own[:-1]
    longest = np.zeros(words.n_docs)
    np.maximum.at(longest, words.doc, length)
    last = counts.data[words.end - 1] if len(words.end) else np.zeros(0, np.uint8)
    first = counts.data[words.start] if len(words.start) else np.zeros(0, np.uint8)
    lines = count_in(_CLASSES["newline"][counts.data], counts.bounds) + 1
    columns = [
        np.log1p(size),
        np.log1p(counts.n_words),
        per_doc(length) / n,
        np.log1p(longest),
        1 - per_doc(again) / n,
        per_doc(adjacent) / n,
        counts.n_repeat_words / n,
        counts.n_dup_lines / lines,
        1 - per_doc(several) / n,
        *(
            count_in(table[counts.data], counts.bounds) / np.maximum(size, 1)
            for table in _CLASSES.values()
        ),
        per_doc((_CLASSES["lower"] | _CLASSES["upper"] | _CLASSES["beyond_ascii"])[last]) / n,
        per_doc(_CLASSES["upper"][first]) / n,
    ]
    return np.column_stack(columns) if words.n_docs else np.zeros((0, len(FEATURES)))
