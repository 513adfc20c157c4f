"""Operator 11: fill-in-middle texts, cut by an indexable skip list.

A text is a list of nodes of ``NODE_BYTES`` bytes. Every node counts the units and the code points that start in it.
A node stands in lane k of the list with probability ``1 / FAN ** k`` (by a hash of its number, so reruns agree); the first
node of a text stands in all. The links of a lane carry two widths, the units and the code points that they jump over, summed
from the links of the lane below. A cut rank is found from the highest lane down: a link is taken as long as the units
passed stay within the rank, and the code points passed are added up on the way. In the node reached the rest
is counted byte by byte. So a cut costs the logarithm of the text's length, and never parts a unit.

A unit is a code point by default; with ``unit`` it is a match of that regular expression or a stretch between
two matches, so words or lines can be cut as well. Where a text is cut comes from sha256 of ``seed:doc_id``: no state, no order of rows.

NULL texts count as empty, an empty text is plain. A text that holds one of the marks is plain, as it could not be told apart
from a transformed one. A NULL id counts as an empty one; repeated rows get the same cuts. An empty table gives no
rows. Extra columns are kept; those named as an output are replaced.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from ledgerline.llm.arrow import append_columns, text_bytes
from ledgerline.llm.words import mix

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
#: Of 100 texts so many are transformed, and so many of these start with the suffix.
TRANSFORMED, SUFFIX_FIRST = 90, 20
NODE_BYTES = 64
FAN = 4

_CUTS = [f"h{k}" for k in range(1, 5)]
_OUT = T.StructType(
    [
        T.StructField("n", T.LongType()),
        T.StructField("form", T.StringType()),
        T.StructField("prefix_chars", T.LongType()),
        T.StructField("middle_chars", T.LongType()),
        T.StructField("output", T.StringType()),
    ]
)


class Lane:
    """The nodes of one lane: ``node`` numbers, widths of the links that leave them, whether a link ends its
    text, and where the node stands in the lane below."""

    def __init__(self, node, units, chars, last, below):
        self.node, self.units, self.chars, self.last, self.below = node, units, chars, last, below


class SkipList:
    """One list for each text, from flags of the bytes at which a unit or a code point starts."""

    def __init__(self, bounds: np.ndarray, unit_starts: np.ndarray, char_starts: np.ndarray):
        self.bounds, self.unit_starts, self.char_starts = bounds, unit_starts, char_starts
        n_nodes = np.maximum(-(-np.diff(bounds) // NODE_BYTES), 1)
        self.first = np.cumsum(n_nodes) - n_nodes
        doc = np.repeat(np.arange(len(n_nodes)), n_nodes)
        number = np.arange(len(doc)) - self.first[doc]
        self.start = bounds[doc] + number * NODE_BYTES
        self.end = np.minimum(self.start + NODE_BYTES, bounds[doc + 1])
        units, chars = (self._per_node(flags) for flags in (unit_starts, char_starts))
        last = np.zeros(len(doc), bool)
        last[self.first + n_nodes - 1] = True
        height = self._heights(number)
        self.lanes = [Lane(np.arange(len(doc)), units, chars, last, None)]
        while (height[self.lanes[-1].node] > len(self.lanes) - 1).any():
            self.lanes.append(self._express(self.lanes[-1], doc, height, len(self.lanes)))

    def _per_node(self, flags: np.ndarray) -> np.ndarray:
        kind = np.int32 if len(flags) < 1 << 31 else np.int64
        before = np.concatenate([np.zeros(1, kind), np.cumsum(flags, dtype=kind)])
        return (before[self.end] - before[self.start]).astype(np.int64)

    def _heights(self, number: np.ndarray) -> np.ndarray:
        """0 for FAN - 1 of FAN nodes, 1 for FAN - 1 of FAN of the others, and so on."""
        digits = mix(number.astype(np.uint64))
        height, alive = np.zeros(len(number), np.int64), number > 0
        while alive.any():
            alive &= digits % np.uint64(FAN) == 0
            digits //= np.uint64(FAN)
            height += alive
            alive &= digits > 0
        top = int(height.max(initial=0))
        height[number == 0] = top
        return height

    @staticmethod
    def _express(lane: Lane, doc: np.ndarray, height: np.ndarray, level: int) -> Lane:
        up = np.flatnonzero(height[lane.node] >= level)
        node = lane.node[up]
        last = np.append(doc[node[1:]] != doc[node[:-1]], True)
        return Lane(
            node, np.add.reduceat(lane.units, up), np.add.reduceat(lane.chars, up), last, up
        )

    def sizes(self) -> np.ndarray:
        """The units of each text."""
        if not len(self.first):
            return np.zeros(0, np.int64)
        return np.add.reduceat(self.lanes[0].units, self.first)

    def find(self, texts: np.ndarray, ranks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The byte at which unit ``rank`` of the text starts (its end, for the number of its units), and
        the code points before it."""
        rest, chars = ranks.astype(np.int64), np.zeros(len(ranks), np.int64)
        top = self.lanes[-1]
        at = np.searchsorted(top.node, self.first[texts])
        for lane in reversed(self.lanes):
            going = np.arange(len(at))
            while len(going):
                here = at[going]
                going = going[~lane.last[here] & (lane.units[here] <= rest[going])]
                rest[going] -= lane.units[at[going]]
                chars[going] += lane.chars[at[going]]
                at[going] += 1
            if lane.below is not None:
                at = lane.below[at]
        return self._inside(at, texts, rest, chars)

    def _inside(self, node, texts, rest, chars) -> tuple[np.ndarray, np.ndarray]:
        """From the start of a node on to the unit ``rest``, byte by byte."""
        width = np.arange(NODE_BYTES)
        place = self.start[node][:, None] + width
        valid = place < self.end[node][:, None]
        place = np.minimum(place, max(len(self.unit_starts) - 1, 0))
        if not len(self.unit_starts):
            return self.bounds[texts], chars
        units = self.unit_starts[place] & valid
        points = self.char_starts[place] & valid
        found = units & (units.cumsum(axis=1) == rest[:, None] + 1)
        some = found.any(axis=1)
        offset = np.where(some, found.argmax(axis=1), (self.end - self.start)[node])
        passed = (points & (width < offset[:, None])).sum(axis=1)
        return self.start[node] + offset, chars + passed


def unit_starts(data: np.ndarray, bounds: np.ndarray, unit: str | None) -> np.ndarray:
    """Flags of the bytes at which a unit starts."""
    char_starts = (data & 0xC0) != 0x80
    if unit is None:
        return char_starts
    flags = np.zeros(len(data), bool)
    raw, pattern = data.tobytes(), re.compile(unit)
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        if a == b:
            continue
        text = raw[a:b].decode()
        chars = np.flatnonzero(char_starts[a:b]) + a
        edges = {0, *(e for m in pattern.finditer(text) for e in m.span())} - {len(text)}
        flags[chars[sorted(edges)]] = True
    return flags


def seeded(key: Column, seed: int) -> list[Column]:
    """The first four groups of eight digits of sha256 of ``seed:key``, as unsigned integers."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit("")))
    digits = F.sha2(text, 256)
    return [F.conv(F.substring(digits, 8 * k + 1, 8), 16, 10).cast("long") for k in range(4)]


def fill_in_middle(
    docs: DataFrame,
    key: str = "doc_id",
    seed: int = 1,
    unit: str | None = None,
    transformed: int = TRANSFORMED,
    suffix_first: int = SUFFIX_FIRST,
) -> DataFrame:
    """The table with ``n`` (units), ``form`` (plain, psm or spm), ``prefix_chars`` and ``middle_chars`` (code
    points; NULL if plain) and ``output``, the transformed text."""
    marks = [m.encode() for m in (PREFIX, SUFFIX, MIDDLE)]
    kept = [c for c in docs.columns if c not in {*_OUT.names, "_h"}]
    numbered = docs.select(*(F.col(f"`{c}`") for c in kept), F.array(*seeded(F.col(key), seed)).alias("_h"))

    def work(part: pa.RecordBatch) -> dict:
        data, bounds = text_bytes(part.column("text"))
        starts = unit_starts(data, bounds, unit)
        char_starts = (data & 0xC0) != 0x80
        lists = SkipList(bounds, starts, char_starts)
        n = lists.sizes()
        hashes = part.column("_h").flatten().to_numpy().reshape(-1, 4)
        ranks = np.sort(hashes[:, :2] % (n + 1)[:, None], axis=1)
        texts = np.arange(part.num_rows)
        place, chars = lists.find(np.tile(texts, 2), ranks.T.ravel())
        (cut_1, cut_2), (chars_1, chars_2) = place.reshape(2, -1), chars.reshape(2, -1)
        raw = data.tobytes()
        form: list[str] = []
        output: list[bytes] = []
        for k in range(part.num_rows):
            a, b, c, d = (int(x) for x in (bounds[k], cut_1[k], cut_2[k], bounds[k + 1]))
            text = raw[a:d]
            if a == d or hashes[k, 2] % 100 >= transformed or any(m in text for m in marks):
                form.append("plain")
                output.append(text)
                continue
            prefix, middle, suffix = raw[a:b], raw[b:c], raw[c:d]
            if hashes[k, 3] % 100 < suffix_first:
                form.append("spm")
                output.append(b"".join([marks[1], suffix, marks[0], prefix, marks[2], middle]))
            else:
                form.append("psm")
                output.append(b"".join([marks[0], prefix, marks[1], suffix, marks[2], middle]))
        plain = np.array([f == "plain" for f in form], bool)
        return {
            "n": n,
            "form": form,
            "prefix_chars": np.ma.masked_array(chars_1, plain).tolist(),
            "middle_chars": np.ma.masked_array(chars_2 - chars_1, plain).tolist(),
            "output": output,
        }

    return append_columns(numbered, "text", _OUT, work).drop("_h")


def restored(output: str = "output", form: str = "form") -> Column:
    """The text from which a transformed one was made, read from it and its form alone. Marks neither
    overlap each other nor themselves, and the text holds none, so the first place of each is its own."""
    text = F.col(output)

    def between(left: str, right: str | None) -> Column:
        start = F.locate(left, text) + len(left)
        length = (F.locate(right, text) if right else F.length(text) + 1) - start
        return F.substr(text, start, length)

    psm = F.concat(between(PREFIX, SUFFIX), between(MIDDLE, None), between(SUFFIX, MIDDLE))
    spm = F.concat(between(PREFIX, MIDDLE), between(MIDDLE, None), between(SUFFIX, PREFIX))
    return F.when(F.col(form) == "psm", psm).when(F.col(form) == "spm", spm).otherwise(text)
