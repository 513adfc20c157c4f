"""Operator 4: exact top-k inner product search as a Voronoi kNN join.

A vector's components x become the integers floor(256 x). With M the largest norm, a data vector gets one more
component, sqrt(M^2 - |v|^2), and a query a 0: then the k highest inner products are the k nearest neighbours in Euclidean
distance, and the triangle inequality holds.

``PIVOTS`` data vectors split data and queries into Voronoi cells. A cell's summary is its smallest distances to the pivot and the
largest, of different ids; from these alone each group of queries gets a bound on the distance of its k-th neighbour. A data vector is copied to
a group only if its distance to its pivot allows it to lie within that bound. Groups hold at most ``GROUP_QUERIES``
queries and data is dealt in slices of about ``SLICE_ROWS`` rows, so a crowded cell is no crowded task. A task
visits cells nearest first and skips those its queries' best scores so far rule out; the best of all slices
are merged. Bounds are widened by ``SLACK`` against rounding, and scores are exact integers.

NULL vectors and vectors with NULL or non-finite components take no part, nor do rows without an id. Shorter
vectors count as padded with zeros. Of rows with one id a query sees the highest score, and none of its own id. Ties
go to the smaller id. An empty table gives no rows. Extra columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F, types as T

from ledgerline.llm.tables import checked_broadcast, long_field
from ledgerline.operators.cuts import cut

SCALE = 256
PIVOTS = 32
GROUP_QUERIES = 2048
SLICE_ROWS = 50_000
SLACK = 1e-6

_PREPARED = T.StructType([*long_field("vec_id", "dims"), T.StructField("data", T.BinaryType())])


def _matrix(column: pa.ChunkedArray | pa.Array, width: int) -> np.ndarray:
    rows = [np.frombuffer(v.as_buffer(), "<i8") for v in column]
    out = np.zeros((len(rows), width), np.int64)
    for k, row in enumerate(rows):
        out[k, : len(row)] = row
    return out


def integer_vectors(table: DataFrame, key: str = "vec_id", column: str = "embedding") -> DataFrame:
    """``vec_id, dims, data``: components as little-endian 64-bit integers, of rows that take part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, dims, data = [], [], []
            for i, vector in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                values = vector.values
                if i is None or values is None or values.null_count:
                    continue
                v = values.to_numpy(zero_copy_only=False).astype(np.float64)
                if np.isfinite(v).all():
                    ids.append(i)
                    dims.append(len(v))
                    data.append(np.floor(v * SCALE).astype("<i8").tobytes())
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(dims, pa.int64()), pa.array(data, pa.binary())],
                names=_PREPARED.names,
            )

    return table.select(F.col(key).cast("long"), F.col(column)).mapInArrow(run, _PREPARED)


class Space:
    """Pivots, and distances to them in the widened space."""

    def __init__(self, pivots: np.ndarray, top: float):
        self.top = top
        self.pivots = pivots.astype(np.float64)
        self.width = pivots.shape[1]
        lift = np.sqrt(np.maximum(top - (self.pivots**2).sum(axis=1), 0))
        self.lift = lift

    def of_data(self, x: np.ndarray) -> np.ndarray:
        x = x.astype(np.float64)
        lift = np.sqrt(np.maximum(self.top - (x**2).sum(axis=1), 0))
        dots = x @ self.pivots.T + lift[:, None] * self.lift
        return np.sqrt(np.maximum(2 * self.top - 2 * dots, 0))

    def of_queries(self, q: np.ndarray) -> np.ndarray:
        q = q.astype(np.float64)
        norm = (q**2).sum(axis=1)[:, None]
        return np.sqrt(np.maximum(norm + self.top - 2 * q @ self.pivots.T, 0))


def _assigned(rows: DataFrame, space: Space, queries: bool) -> DataFrame:
    """The rows with ``cell`` and ``r``, the nearest pivot and the distance to it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _matrix(batch.column("data"), space.width)
            distance = space.of_queries(x) if queries else space.of_data(x)
            cell = distance.argmin(axis=1)
            r = distance[np.arange(len(x)), cell]
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), batch.column("data"), pa.array(cell), pa.array(r)],
                names=["vec_id", "data", "cell", "r"],
            )

    return rows.mapInArrow(run, "vec_id long, data binary, cell long, r double")


def _of_ids(r: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k smallest distances of different ids, and the ids."""
    order = np.lexsort((ids, r))
    r, ids = r[order], ids[order]
    kept = np.sort(np.unique(ids, return_index=True)[1])[:k]
    return r[kept], ids[kept]


def _smallest(data: DataFrame, k: int) -> dict[int, list[tuple[float, int]]]:
    """The k smallest distances to the pivot in each cell, of different ids, and these ids: k of
    each task and cell, then of each cell."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for batch in batches:
            cell, r, ids = (column.to_numpy() for column in batch.columns)
            for c in np.unique(cell):
                old = held.get(c, (np.zeros(0), np.zeros(0, np.int64)))
                new = r[cell == c], ids[cell == c]
                held[c] = _of_ids(*(np.concatenate(x) for x in zip(old, new, strict=True)), k)
        for c, (r, ids) in held.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(r), c, np.int64)), pa.array(r), pa.array(ids)],
                names=["cell", "r", "vec_id"],
            )

    best = data.select("cell", "r", "vec_id").mapInArrow(run, "cell long, r double, vec_id long")
    best = best.groupBy("cell", "vec_id").agg(F.min("r").alias("r"))
    lists = best.groupBy("cell").agg(
        F.slice(F.sort_array(F.collect_list(F.struct("r", "vec_id"))), 1, k).alias("r")
    )
    return {row["cell"]: [(r, i) for r, i in row["r"]] for row in lists.collect()}  # PIVOTS rows


def _best(
    ids: np.ndarray, x: np.ndarray, query_ids: np.ndarray, q: np.ndarray, k: int
) -> list[tuple[np.ndarray, np.ndarray]]:
    """Of each query the k highest scores and their ids, ties to the smaller id, each id once and
    never the query's own. ``ids`` rise."""
    bound = float(np.abs(x).max(initial=0)) * float(np.abs(q).max(initial=0)) * x.shape[1]
    if bound < 2**52:  # exact in doubles
        scores = (q.astype(np.float64) @ x.astype(np.float64).T).astype(np.int64)
    elif bound < 2**62:
        scores = q @ x.T
    else:  # outside long: the nearest long
        exact = q.astype(object) @ x.astype(object).T
        scores = np.clip(exact, -(2**63), 2**63 - 1).astype(np.int64)
    repeated = len(ids) > 1 and bool((ids[1:] == ids[:-1]).any())
    out = []
    for row, own in zip(scores, query_ids, strict=True):
        keep = np.flatnonzero(ids != own)
        if not repeated and len(keep) > k:
            least = np.partition(row[keep], len(keep) - k)[len(keep) - k]
            keep = keep[row[keep] >= least]
        keep = keep[np.lexsort((ids[keep], -row[keep]))]
        if repeated:
            _, first = np.unique(ids[keep], return_index=True)
            keep = keep[np.sort(first)]
        out.append((row[keep[:k]], ids[keep[:k]]))
    return out


def _solve(
    queries: pa.Table, data: pa.Table, space: Space, near: dict[int, list[tuple[float, int]]], k: int
) -> pa.Table:
    query_ids = queries.column("vec_id").to_numpy()
    q = _matrix(queries.column("data").combine_chunks(), space.width)
    to_pivot = space.of_queries(q)
    x = _matrix(data.column("data").combine_chunks(), space.width)
    ids, cell, r = (data.column(n).to_numpy() for n in ("vec_id", "cell", "r"))
    order = np.lexsort((ids, cell))
    x, ids, cell, r = x[order], ids[order], cell[order], r[order]
    # one neighbour more than asked for, as the query itself may be among them
    reach = np.concatenate([to_pivot[:, [c]] + [r for r, _ in rs] for c, rs in near.items()], axis=1)
    who = np.array([i for rs in near.values() for _, i in rs], np.int64)
    by_id = np.argsort(who, kind="stable")
    _, first = np.unique(who[by_id], return_index=True)
    reach = np.sort(np.minimum.reduceat(reach[:, by_id], first, axis=1), axis=1)
    limit = reach[:, k] if reach.shape[1] > k else np.full(len(q), np.inf)
    cells, starts = np.unique(cell, return_index=True)
    ends = np.append(starts[1:], len(cell))
    nearest = np.argsort(to_pivot[:, cells].mean(axis=0))
    norm = (q.astype(np.float64) ** 2).sum(axis=1) + space.top
    best: list[tuple[np.ndarray, np.ndarray]] = [(np.zeros(0, np.int64),) * 2 for _ in q]
    for c in nearest:
        a, b = starts[c], ends[c]
        distance = to_pivot[:, cells[c]]
        gap = np.maximum(distance - r[a:b].max(), r[a:b].min() - distance)
        active = np.flatnonzero(gap <= limit * (1 + SLACK) + SLACK)
        if not len(active):
            continue
        found = _best(ids[a:b], x[a:b], query_ids[active], q[active], k)
        for i, (score, who) in zip(active, found, strict=True):
            score, who = np.concatenate([best[i][0], score]), np.concatenate([best[i][1], who])
            kept = np.lexsort((who, -score))
            kept = kept[np.sort(np.unique(who[kept], return_index=True)[1])][:k]
            best[i] = score[kept], who[kept]
            if len(kept) == k:
                limit[i] = min(limit[i], math.sqrt(max(norm[i] - 2.0 * float(score[kept[-1]]), 0)))
    sizes = [len(who) for _, who in best]
    return pa.table(
        {
            "query_id": np.repeat(query_ids, sizes),
            "vec_id": np.concatenate([who for _, who in best]),
            "score": np.concatenate([score for score, _ in best]),
        }
    )


def top_k(
    table: DataFrame,
    is_query,
    k: int = 5,
    n_pivots: int = PIVOTS,
    group_queries: int = GROUP_QUERIES,
    slice_rows: int = SLICE_ROWS,
) -> DataFrame:
    """``query_id, rank, vec_id, score``. ``is_query`` is a condition on ``vec_id``."""
    spark = table.sparkSession
    vectors = cut(integer_vectors(table), "vectors")
    ids = vectors.select("vec_id").distinct().orderBy(F.xxhash64("vec_id"), "vec_id").limit(n_pivots)
    picked = vectors.where(F.col("vec_id").isin([row["vec_id"] for row in ids.collect()]))
    picked = picked.groupBy("vec_id").agg(F.min("data").alias("data")).orderBy("vec_id").toPandas()
    width = int(vectors.agg(F.max("dims")).first()[0] or 0)
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    if not len(picked) or not width:
        return empty
    pivots = _matrix(pa.array(picked["data"].tolist(), pa.binary()), width)
    space = Space(pivots, _largest_norm(vectors, width))
    data = cut(_assigned(vectors, space, False), "voronoi-data")
    queries = cut(_assigned(vectors.where(is_query), space, True), "voronoi-queries")
    near = _smallest(data, k + 1)
    # one row for each cell
    groups = {
        row["cell"]: (row["n"], row["far"])
        for row in queries.groupBy("cell").agg(F.count("*").alias("n"), F.max("r").alias("far")).collect()
    }
    between = np.sqrt(
        np.maximum(
            ((space.pivots[:, None] - space.pivots[None]) ** 2).sum(axis=2)
            + (space.lift[:, None] - space.lift[None]) ** 2,
            0,
        )
    )
    needs, deals, block, free = [], [], -1, 0
    for i, (n, far) in sorted(groups.items()):
        if n > free:
            block, free = block + 1, group_queries
        parts = max(1, math.ceil(n / group_queries))
        deals.append((int(i), block, parts))
        found = [(far + between[i][j] + r, who) for j, rs in near.items() for r, who in rs]
        reach, _ = _of_ids(*(np.array(x) for x in zip(*found, strict=True)), k + 1)
        limit = (reach[k] if len(reach) > k else math.inf) * (1 + SLACK) + SLACK
        for j in near:
            low, high = between[i][j] - far - limit, between[i][j] + far + limit
            needs += [(int(j), block + part, float(low), float(high)) for part in range(parts)]
        block, free = block + parts - 1, (free - n if parts == 1 else 0)
    if not deals:
        return empty
    slices = max(1, math.ceil(data.count() / slice_rows))
    needs = spark.createDataFrame(needs, "cell long, block int, low double, high double")
    needs = needs.groupBy("cell", "block").agg(F.min("low").alias("low"), F.max("high").alias("high"))
    deals = spark.createDataFrame(deals, "cell long, first int, parts int")
    part = F.pmod(F.xxhash64("vec_id"), F.col("parts")).cast("int")
    asked = (
        queries.join(checked_broadcast(deals), "cell")
        .withColumn("block", F.col("first") + part)
        .select(
            "block",
            F.explode(F.sequence(F.lit(0), F.lit(slices - 1))).alias("slice"),
            "vec_id",
            "data",
        )
    )
    copied = (
        data.join(checked_broadcast(needs), "cell")
        .where("r >= low and r <= high")
        .withColumn("slice", F.pmod(F.xxhash64("vec_id"), F.lit(slices)).cast("int"))
        .select("block", "slice", "vec_id", "data", "cell", "r")
    )

    def solve(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return pa.table({n: pa.array([], pa.int64()) for n in ("query_id", "vec_id", "score")})
        return _solve(left, right, space, near, k)

    found = (
        asked.groupBy("block", "slice")
        .cogroup(copied.groupBy("block", "slice"))
        .applyInArrow(solve, "query_id long, vec_id long, score long")
    )
    best = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    ranked = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def _largest_norm(vectors: DataFrame, width: int) -> float:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        top = 0.0
        for batch in batches:
            if batch.num_rows:
                x = _matrix(batch.column(0), width).astype(np.float64)
                top = max(top, float((x**2).sum(axis=1).max()))
        yield pa.RecordBatch.from_arrays([pa.array([top])], names=["norm"])

    norms = vectors.select("data").mapInArrow(run, "norm double")
    return float(norms.agg(F.max("norm")).first()[0] or 0.0)
