"""Operator 12: product codes of vectors by dual-tree Lloyd.

A vector's components x become the integers floor(1024 x); its parts are coded each by the nearest of ``ENTRIES`` entries of their
codebook. Codebooks start as the parts of the vectors of smallest id; a round assigns all parts and moves each entry to
the floor of the mean of its parts.

Vectors lie in slices of ``SLICE``, and each part of a slice has a tree, built once: halves along the widest
side of their box, down to ``LEAF`` vectors, every node with its box and the cached sum of its vectors. The entries of a part
have a tree as well, of one entry a leaf. Both are descended together: the boxes bound the distances between a node of parts
and a node of entries, and a pair goes if it lies strictly farther than the largest distance to some other. A node of parts with one entry left is
assigned whole, and its sum is added from the cache. Leaves that stay uncertain compare their vectors with the entries left, in integers
throughout, so ties go to the lower entry as they must. A round sends sums by entry only, summed again by Spark; the driver
holds codebooks, whose size is fixed.

NULL vectors and vectors with NULL or non-finite components are dropped. Shorter vectors count as padded with zeros, up to a width that
the parts divide. Rows with a NULL id come last in the order of ids, rows of one id in the order of their vectors; repeated rows
are coded each. With fewer vectors than entries the codebooks are shorter. Integers so large that a squared distance might not
fit into 64 bits are set to the largest that fits. An empty table gives no rows. Extra columns are kept;
those named as an output are replaced.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import sha256

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F, types as T

from ledgerline.llm.tables import checked_broadcast
from ledgerline.operators.cuts import cut

SCALE = 1024
PARTS = 4
ENTRIES = 256
ROUNDS = 4
SLICE = 2048
LEAF = 32


class Tree:
    """Boxes, and for points sums, of the halves of points and their halves, level by level. The points of
    node j on level l are those from edges[l][j] to edges[l][j + 1] in the tree's order."""

    def __init__(self, n: int, leaf: int):
        depth = 0
        while n > leaf << depth:
            depth += 1
        self.edges = [np.arange((1 << level) + 1) * n >> level for level in range(depth + 1)]

    def order(self, points: np.ndarray) -> np.ndarray:
        """The tree's order of the points."""
        order = np.arange(len(points))
        for level, inner in zip(self.edges[:-1], self.edges[1:], strict=True):
            for j in range(len(level) - 1):
                a, b, middle = level[j], level[j + 1], inner[2 * j + 1] - level[j]
                if b - a > 1:
                    own = points[order[a:b]]
                    side = int(np.argmax(own.max(axis=0) - own.min(axis=0)))
                    order[a:b] = order[a:b][np.argpartition(own[:, side], middle)]
        return order

    def reduce(self, ordered: np.ndarray, work: np.ufunc) -> list[np.ndarray]:
        """Of each node, level by level, from the leaves up."""
        found = [work.reduceat(ordered, self.edges[-1][:-1], axis=0)]
        for edges in reversed(self.edges[:-1]):
            found.insert(0, work.reduceat(ordered, edges[:-1], axis=0))
        return found


@dataclass
class Book:
    """The entries of one part, and their tree."""

    entries: np.ndarray

    def __post_init__(self):
        self.tree = Tree(len(self.entries), 1)
        self.order = self.tree.order(self.entries)
        ordered = self.entries[self.order]
        self.low, self.high = (self.tree.reduce(ordered, w) for w in (np.minimum, np.maximum))


@dataclass
class Points:
    """One part of a slice in its tree's order, with boxes and cached sums."""

    points: np.ndarray
    tree: Tree
    low: list[np.ndarray]
    high: list[np.ndarray]
    total: list[np.ndarray]

    @classmethod
    def of(cls, ordered: np.ndarray, leaf: int = LEAF) -> "Points":
        tree = Tree(len(ordered), leaf)
        return cls(ordered, tree, *(tree.reduce(ordered, w) for w in (np.minimum, np.maximum, np.add)))


def nearest(
    points: Points, book: Book, sums: np.ndarray | None = None, counts: np.ndarray | None = None
) -> np.ndarray:
    """The nearest entry of each point, ties to the lower one; ``sums`` and ``counts`` by entry are
    added to."""
    code = np.zeros(len(points.points), np.int64)
    node, entry = np.zeros(1, np.int64), np.zeros(1, np.int64)
    level, depth = 0, 0
    bottom, last = len(points.tree.edges) - 1, len(book.tree.edges) - 1
    while len(node):
        low, high = points.low[level][node], points.high[level][node]
        gap = np.maximum(np.maximum(book.low[depth][entry] - high, low - book.high[depth][entry]), 0)
        far = np.maximum(book.high[depth][entry] - low, high - book.low[depth][entry])
        nearest_by, farthest_by = (gap * gap).sum(axis=1), (far * far).sum(axis=1)
        first = np.flatnonzero(np.diff(node, prepend=-1))
        owner = np.cumsum(np.diff(node, prepend=-1) != 0) - 1
        bound = np.minimum.reduceat(farthest_by, first)
        near = nearest_by <= bound[owner]
        node, entry = node[near], entry[near]
        edges = book.tree.edges[depth]
        sole = np.diff(edges)[entry] == 1
        alone = np.bincount(node, minlength=len(points.tree.edges[level]) - 1)[node] == 1
        settled = sole & alone
        for j, e in zip(node[settled].tolist(), book.order[edges[entry[settled]]].tolist(), strict=True):
            a, b = points.tree.edges[level][j : j + 2]
            code[a:b] = e
            if sums is not None:
                sums[e] += points.total[level][j]
                counts[e] += b - a
        node, entry = node[~settled], entry[~settled]
        if level == bottom and depth == last:
            _compare(points, book, node, book.order[book.tree.edges[depth][entry]], code, sums, counts)
            break
        if level < bottom:
            node, entry = np.repeat(2 * node, 2), np.repeat(entry, 2)
            node[1::2] += 1
            level += 1
        if depth < last:
            node, entry = np.repeat(node, 2), np.repeat(2 * entry, 2)
            entry[1::2] += 1
            depth += 1
            some = np.diff(book.tree.edges[depth])[entry] > 0
            node, entry = node[some], entry[some]
        by_node = np.argsort(node, kind="stable")
        node, entry = node[by_node], entry[by_node]
    return code


def _compare(points, book, node, entry, code, sums, counts) -> None:
    """The points of uncertain leaves against the entries left to each."""
    if not len(node):
        return
    by_entry = np.lexsort((entry, node))
    node, entry = node[by_entry], entry[by_entry]
    x, e = points.points, book.entries
    top = max(np.abs(x).max(initial=0), np.abs(e).max(initial=0))
    # whole numbers below 2^53 are exact in floating point, and their products much faster
    kind = np.float64 if 4 * int(top) ** 2 * x.shape[1] < 1 << 53 else np.int64
    x, e = x.astype(kind), e.astype(kind)
    norms = (e * e).sum(axis=1)
    starts = np.flatnonzero(np.diff(node, prepend=-1))
    edges = points.tree.edges[-1]
    uncertain = np.zeros(len(code), bool)
    for s, t in zip(starts.tolist(), [*starts[1:].tolist(), len(node)], strict=True):
        a, b = edges[node[s]], edges[node[s] + 1]
        left = entry[s:t]
        code[a:b] = left[(norms[left] - 2 * (x[a:b] @ e[left].T)).argmin(axis=1)]
        uncertain[a:b] = True
    if sums is not None:
        own = code[uncertain]
        by_code = np.argsort(own, kind="stable")
        own = own[by_code]
        first = np.flatnonzero(np.diff(own, prepend=-1))
        sums[own[first]] += np.add.reduceat(points.points[uncertain][by_code], first, axis=0)
        counts += np.bincount(own, minlength=len(counts))


def kept_vectors(table: DataFrame, column: str = "embedding") -> DataFrame:
    finite = f"not exists(`{column}`, x -> x is null or not abs(double(x)) < double('infinity'))"
    return table.where(F.col(column).isNotNull()).where(finite)


def _limit(width: int) -> int:
    """The largest integer of which a whole squared distance fits into 64 bits."""
    return math.isqrt((1 << 61) // width)


def integers(vectors: list[np.ndarray], width: int) -> np.ndarray:
    out = np.zeros((len(vectors), width), np.float64)
    for k, v in enumerate(vectors):
        out[k, : len(v)] = v
    limit = _limit(width)
    with np.errstate(over="ignore"):
        return np.clip(np.floor(out * SCALE), -limit, limit).astype(np.int64)


def _vectors(column: pa.Array) -> list[np.ndarray]:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    ends = np.cumsum(pc.list_value_length(column).to_numpy(zero_copy_only=False))
    return np.split(flat, ends[:-1].astype(np.int64)) if len(ends) else []


def sliced(vectors: DataFrame, column: str, width: int, parts: int = PARTS, size: int = SLICE) -> DataFrame:
    """One row for each slice: the other columns as arrays, ``_points`` of all parts in the order of their trees, and that
    order, ``_order``."""
    others = [f for f in vectors.schema.fields if f.name != column]
    schema = T.StructType(
        [T.StructField(f.name, T.ArrayType(f.dataType)) for f in others]
        + [T.StructField(n, T.BinaryType()) for n in ("_points", "_order")]
    )
    rows = vectors.select(*(F.col(f"`{f.name}`") for f in others), F.col(f"`{column}`").alias("_vector"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def flush() -> pa.RecordBatch:
            table = pa.Table.from_batches(held).combine_chunks()
            x = integers(_vectors(table.column("_vector").combine_chunks()), width)
            x = x.reshape(len(x), parts, -1).transpose(1, 0, 2)
            tree = Tree(x.shape[1], LEAF)
            order = np.stack([tree.order(own) for own in x])
            points = np.take_along_axis(x, order[:, :, None], axis=1)
            columns = []
            for f in others:
                values = table.column(f.name).combine_chunks()
                columns.append(pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values))
            raw = [points.astype("<i8").tobytes(), order.astype("<i4").tobytes()]
            columns += [pa.array([b], pa.binary()) for b in raw]
            return pa.RecordBatch.from_arrays(columns, names=schema.names)

        count = 0
        for batch in batches:
            while batch.num_rows:
                part = batch.slice(0, size - count)
                batch = batch.slice(part.num_rows)
                held.append(part)
                count += part.num_rows
                if count == size:
                    yield flush()
                    held, count = [], 0
        if count:
            yield flush()

    return rows.mapInArrow(run, schema)


def _parts(raw: bytes, n: int, parts: int) -> list[Points]:
    points = np.frombuffer(raw, "<i8").reshape(parts, n, -1)
    return [Points.of(own) for own in points]


def _sums(slices: DataFrame, codebooks: np.ndarray) -> DataFrame:
    """``slot`` (part and entry), ``position``, ``count`` and ``total`` over all slices."""
    parts, k, w = codebooks.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books = [Book(own) for own in codebooks]
        sums, counts = np.zeros((parts, k, w), np.int64), np.zeros((parts, k), np.int64)
        for batch in batches:
            for points, order in zip(batch.column("_points"), batch.column("_order"), strict=True):
                n = len(order.as_buffer()) // (4 * parts)
                for p, own in enumerate(_parts(points.as_buffer(), n, parts)):
                    nearest(own, books[p], sums[p], counts[p])
        slot, position = np.divmod(np.arange(parts * k * w), w)
        yield pa.RecordBatch.from_arrays(
            [pa.array(slot), pa.array(position), pa.array(np.repeat(counts.ravel(), w)), pa.array(sums.ravel())],
            names=["slot", "position", "count", "total"],
        )

    made = slices.select("_points", "_order").mapInArrow(
        run, "slot long, position long, count long, total long"
    )
    wide = F.col("total").cast("decimal(38,0)")
    return made.where("count > 0").groupBy("slot", "position").agg(
        F.sum("count").alias("count"), F.sum(wide).alias("total")
    )


def train(slices: DataFrame, seeds: np.ndarray, rounds: int = ROUNDS) -> np.ndarray:
    """Codebooks (part, entry, position) after ``rounds``, from those of the seeds."""
    codebooks = seeds.copy()
    parts, k, w = codebooks.shape
    for _ in range(rounds):
        for row in _sums(slices, codebooks).collect():  # a row for each component of the codebooks
            p, e = divmod(row["slot"], k)
            codebooks[p, e, row["position"]] = int(row["total"]) // row["count"]
    return codebooks


def coded(slices: DataFrame, codebooks: np.ndarray) -> DataFrame:
    """The other columns of the vectors with ``code`` and ``error``."""
    others = [f for f in slices.schema.fields if f.name not in ("_points", "_order")]
    schema = T.StructType(
        [T.StructField(f.name, f.dataType.elementType) for f in others]
        + [T.StructField("code", T.StringType()), T.StructField("error", T.LongType())]
    )
    parts = len(codebooks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books: list[Book] = []
        for batch in batches:
            for row in range(batch.num_rows):
                books = books or [Book(own) for own in codebooks]
                order = np.frombuffer(batch.column("_order")[row].as_buffer(), "<i4").reshape(parts, -1)
                code = np.zeros((order.shape[1], parts), np.uint8)
                error = np.zeros(order.shape[1], np.int64)
                raw = batch.column("_points")[row].as_buffer()
                for p, own in enumerate(_parts(raw, order.shape[1], parts)):
                    found = nearest(own, books[p])
                    off = own.points - codebooks[p][found]
                    code[order[p], p] = found
                    error[order[p]] += (off * off).sum(axis=1)
                text, size = code.tobytes().hex(), 2 * parts
                texts = [text[k : k + size] for k in range(0, len(text), size)]
                columns = [batch.column(f.name)[row].values for f in others]
                yield pa.RecordBatch.from_arrays(
                    [*columns, pa.array(texts, pa.string()), pa.array(error)], names=schema.names
                )

    return slices.mapInArrow(run, schema)


def codebooks_sha256(codebooks: np.ndarray) -> str:
    return sha256(",".join(map(str, codebooks.ravel().tolist())).encode()).hexdigest()


def vector_codes(
    table: DataFrame,
    key: str = "vec_id",
    column: str = "embedding",
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
) -> tuple[DataFrame, np.ndarray]:
    """The table without ``column``, of the vectors that take part, with ``code`` (two hexadecimal digits a part) and
    ``error`` (squared distances); and the codebooks (part, entry, position)."""
    if not 0 < entries <= 256:
        raise ValueError("a code has two hexadecimal digits a part: 1 to 256 entries")
    names = [c for c in table.columns if c not in ("code", "error")]
    kept = kept_vectors(table.select(*(F.col(f"`{c}`") for c in names)), column)
    width = kept.agg(F.max(F.size(column))).first()[0] or 1
    width = -(-width // parts) * parts
    seeds = kept.orderBy(F.col(key).asc_nulls_last(), column).limit(entries).select(column).collect()
    start = integers([np.array(r[0], np.float64) for r in seeds], width)
    start = start.reshape(len(start), parts, width // parts).transpose(1, 0, 2)
    slices = cut(sliced(kept, column, width, parts), "slices")
    codebooks = train(slices, start, rounds) if len(seeds) else start
    return coded(slices, codebooks), codebooks


def with_label_errors(codes: DataFrame, label: str = "label") -> DataFrame:
    """``codes`` (a written table) with ``label_error``, the error summed over equal labels, NULL ones together."""
    sums = codes.groupBy(F.col(label).alias("_label")).agg(
        F.sum(F.col("error").cast("decimal(38,0)")).cast("long").alias("label_error")
    )
    sums = checked_broadcast(cut(sums, "label-errors"))
    return codes.join(sums, F.col(label).eqNullSafe(F.col("_label")), "left").drop("_label")
