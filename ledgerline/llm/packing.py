"""Operator 5: best-fit packing by a grouping genetic algorithm on islands.

Documents become pieces of at most ``capacity`` ids; pieces go by hash to lots of about
``LOT`` pieces, and each lot is packed by ``ISLANDS`` populations in tasks of their own. A solution is a
list of bins, and the bins are what is inherited: crossover injects well-filled bins of one parent into the other,
drops the bins that hold the same pieces, and puts the displaced pieces back by best fit, longest
first. After each epoch the best solution of an island joins the next island of its lot. A lot
whose lower bound is reached stops. Bins that stay loosely filled in any lot are opened and their
pieces packed once more, among themselves.

Only lengths travel in the search; lots and populations have bounded size whatever the table's.
All random choices are seeded by lot and island, so reruns agree.

NULL texts count as empty: a piece of the end id alone. Repeated rows are packed each; an empty
table gives no rows. Columns other than ``doc_id`` and ``text`` are ignored.
"""

from __future__ import annotations

import math
import random
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F, types as T

from ledgerline.llm.arrow import CHUNK_BYTES, chunks, release
from ledgerline.llm.tables import long_field
from ledgerline.llm.tokens import REMEMBERED, encoder, id_type, vocabulary_path
from ledgerline.operators.cuts import cut

CAPACITY = 2048
END_ID = 0
LOT = 4096
ISLANDS = 2
EPOCHS = 2
POPULATION = 6
GENERATIONS = 4
#: Bytes of text a task encodes at once where its ids don't travel: a word's later places in it cost little.
TEXT_BYTES = 4 * CHUNK_BYTES
#: Bins filled to less than this share are opened for the second round.
LOOSE = 0.97

Bins = list[list[int]]


def best_fit(lengths: list[int], items: list[int], bins: Bins, capacity: int) -> Bins:
    """Put each item into the fullest bin that still takes it, else into a new bin. A bit set of
    the room left in bins finds that bin without a search."""
    room: list[list[int]] = [[] for _ in range(capacity + 1)]
    free = 0
    for b, members in enumerate(bins):
        left = capacity - sum(lengths[i] for i in members)
        room[left].append(b)
        free |= 1 << left
    for i in items:
        size = lengths[i]
        fits = free >> size
        if fits:
            left = size + (fits & -fits).bit_length() - 1
            b = room[left].pop()
            if not room[left]:
                free ^= 1 << left
            bins[b].append(i)
        else:
            left, b = capacity, len(bins)
            bins.append([i])
        room[left - size].append(b)
        free |= 1 << (left - size)
    return bins


def fitness(lengths: list[int], bins: Bins, capacity: int) -> tuple[int, float]:
    """Fewer bins first; then fill squared, which favours full bins beside empty ones."""
    fill = sum((sum(lengths[i] for i in members) / capacity) ** 2 for members in bins)
    return -len(bins), fill


def crossover(
    lengths: list[int], giver: Bins, taker: Bins, capacity: int, rng: random.Random
) -> Bins:
    ranked = sorted(giver, key=lambda members: -sum(lengths[i] for i in members))
    best = ranked[: max(1, len(ranked) // 2)]
    injected = rng.sample(best, max(1, len(best) // 3))
    taken = {i for members in injected for i in members}
    kept, displaced = [list(members) for members in injected], []
    for members in taker:
        if taken.isdisjoint(members):
            kept.append(list(members))
        else:
            displaced += [i for i in members if i not in taken]
    displaced.sort(key=lambda i: -lengths[i])
    return best_fit(lengths, displaced, kept, capacity)


def mutate(lengths: list[int], bins: Bins, capacity: int, rng: random.Random) -> Bins:
    """Open the emptiest bins and some others, and put their pieces back by best fit."""
    ranked = sorted(bins, key=lambda members: sum(lengths[i] for i in members))
    opened = max(2, len(bins) // 20)
    picked = ranked[:opened]
    rest = ranked[opened:]
    rng.shuffle(rest)
    picked, rest = picked + rest[:opened], [list(m) for m in rest[opened:]]
    items = sorted((i for members in picked for i in members), key=lambda i: -lengths[i])
    return best_fit(lengths, items, rest, capacity)


def lower_bound(lengths: list[int], capacity: int) -> int:
    return max(-(-sum(lengths) // capacity), sum(2 * x > capacity for x in lengths))


def evolve(
    lengths: list[int], capacity: int, seeds: list[Bins], rng: random.Random
) -> Bins:
    """One epoch of one island, from given solutions and its own; the best solution."""
    target = lower_bound(lengths, capacity)
    order = sorted(range(len(lengths)), key=lambda i: -lengths[i])
    people = list(seeds)
    if all(len(bins) > target for bins in seeds):
        people.append(best_fit(lengths, order, [], capacity))

    def rank() -> None:
        if len(people) > 1:
            people.sort(key=lambda bins: fitness(lengths, bins, capacity), reverse=True)

    rank()
    if len(people[0]) <= target:
        return people[0]
    while len(people) < POPULATION:
        mixed = sorted(order, key=lambda i: -lengths[i] * rng.uniform(0.8, 1.2))
        people.append(best_fit(lengths, mixed, [], capacity))
    for _ in range(GENERATIONS):
        rank()
        if len(people[0]) <= target:
            break
        half = POPULATION // 2
        for k in range(half, POPULATION):
            giver, taker = rng.sample(people[:half], 2) if half > 1 else people[:1] * 2
            child = crossover(lengths, giver, taker, capacity, rng)
            people[k] = mutate(lengths, child, capacity, rng) if rng.random() < 0.5 else child
    rank()
    return people[0]


def _genes(bins: Bins, n: int) -> list[int]:
    out = [0] * n
    for b, members in enumerate(bins):
        for i in members:
            out[i] = b
    return out


def _bins(genes: list[int]) -> Bins:
    out: Bins = [[] for _ in range(max(genes, default=-1) + 1)]
    for i, b in enumerate(genes):
        out[b].append(i)
    return out


_STATE = T.StructType(
    [
        *long_field("lot", "island", "n_bins"),
        T.StructField("fill", T.DoubleType()),
        *(T.StructField(n, T.ArrayType(T.LongType())) for n in ("lengths", "uids", "genes")),
    ]
)


def _epoch(state: DataFrame, capacity: int, epoch: int) -> DataFrame:
    """Evolve every row (lot, island, lengths, uids, genes, guest); genes may be NULL."""
    schema = pa.schema(
        [pa.field(n, pa.int64()) for n in ("lot", "island", "n_bins")]
        + [pa.field("fill", pa.float64())]
        + [pa.field(n, pa.list_(pa.int64())) for n in ("lengths", "uids", "genes")]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                row = {name: batch.column(name)[k].as_py() for name in batch.schema.names}
                lengths = row["lengths"]
                rng = random.Random(f"{row['lot']}/{row['island']}/{epoch}")
                seeds = [_bins(row[g]) for g in ("genes", "guest") if row[g] is not None]
                best = evolve(lengths, capacity, seeds, rng)
                count, fill = fitness(lengths, best, capacity)
                row |= {"n_bins": -count, "fill": fill, "genes": _genes(best, len(lengths))}
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row[f.name]], f.type) for f in schema], schema=schema
                )

    return state.mapInArrow(run, _STATE)


def pack(
    pieces: DataFrame,
    capacity: int = CAPACITY,
    lot_size: int = LOT,
    islands: int = ISLANDS,
    epochs: int = EPOCHS,
) -> DataFrame:
    """Bins for pieces with ``uid`` (unique) and ``length`` (1 to capacity): ``uid``, ``lot``,
    ``bin``, ``offset``, ``fill`` (of the bin). ``pieces`` should be a written table."""
    lots = max(1, math.ceil(pieces.count() / lot_size))
    tasks = min(lots * islands, max(lots, pieces.sparkSession.sparkContext.defaultParallelism))
    member = F.sort_array(F.collect_list(F.struct((-F.col("length")).alias("l"), "uid")))
    state = (
        pieces.withColumn("lot", F.pmod(F.xxhash64("uid"), F.lit(lots)))
        .groupBy("lot")
        .agg(member.alias("m"))
        .select(
            "lot",
            F.transform("m.l", lambda x: -x).alias("lengths"),
            F.col("m.uid").alias("uids"),
            F.explode(F.sequence(F.lit(0).cast("long"), F.lit(islands - 1).cast("long"))).alias(
                "island"
            ),
            F.lit(None).cast("array<bigint>").alias("genes"),
            F.lit(None).cast("array<bigint>").alias("guest"),
        )
    )
    for epoch in range(epochs):
        if epoch:
            elite = state.select(
                "lot",
                F.pmod(F.col("island") + 1, F.lit(islands)).alias("island"),
                F.col("genes").alias("guest"),
            )
            state = state.join(elite, ["lot", "island"])
        spread = state.repartition(tasks, "lot", "island")
        state = cut(_epoch(spread, capacity, epoch), f"islands-{epoch}")
    best = state.groupBy("lot").agg(
        F.max_by(
            F.struct("uids", "lengths", "genes"),
            F.struct(-F.col("n_bins"), F.col("fill"), -F.col("island")),
        ).alias("best")
    )
    return _places(best.select("lot", "best.*"))


_PLACES = T.StructType(long_field("uid", "lot", "bin", "offset", "fill"))


def _places(best: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                lengths = np.array(batch.column("lengths")[k].as_py(), np.int64)
                genes = np.array(batch.column("genes")[k].as_py(), np.int64)
                uids = np.array(batch.column("uids")[k].as_py(), np.int64)
                order = np.argsort(genes, kind="stable")
                total = np.cumsum(lengths[order]) - lengths[order]
                owner = genes[order]
                first = np.searchsorted(owner, owner)
                fill = np.bincount(genes, lengths).astype(np.int64)
                made = {
                    "uid": uids[order],
                    "lot": np.full(len(order), batch.column("lot")[k].as_py()),
                    "bin": owner,
                    "offset": total - total[first],
                    "fill": fill[owner],
                }
                yield pa.RecordBatch.from_pydict(made)

    return best.mapInArrow(run, _PLACES)


_PIECES = T.StructType(long_field("doc_id", "uid", "piece", "start", "length", "ids_crc32"))


def cut_pieces(
    docs: DataFrame,
    vocabulary: str | None = None,
    capacity: int = CAPACITY,
    end_id: int = END_ID,
    with_ids: bool = False,
    remembered: int = REMEMBERED,
) -> DataFrame:
    """The pieces of all documents; on demand with ``ids``, as little-endian numbers of two bytes, or four for a vocabulary
    of more than 65,536. ``uid`` is unique in the result."""
    vocabulary = vocabulary or vocabulary_path()
    schema = _PIECES
    if with_ids:
        schema = T.StructType(
            [*_PIECES.fields, T.StructField("ids", T.BinaryType())]
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = TaskContext.get().partitionId() << 40
        model, kind = encoder(vocabulary, remembered), id_type(vocabulary) if with_ids else None
        for batch in batches:
            for rows in chunks(batch, "text", CHUNK_BYTES if with_ids else TEXT_BYTES):
                ids, bounds = model.encode(rows.column("text"), end_id)
                size = np.diff(bounds)
                n = -(-size // capacity)
                doc = np.repeat(np.arange(len(size)), n)
                piece = np.arange(len(doc)) - np.repeat(np.cumsum(n) - n, n)
                start = piece * capacity
                length = np.minimum(size[doc] - start, capacity)
                at = bounds[doc] + start
                raw = memoryview(np.ascontiguousarray(ids, "<u4").tobytes())
                crcs = [
                    zlib.crc32(raw[4 * a : 4 * b])
                    for a, b in zip(at.tolist(), (at + length).tolist(), strict=True)
                ]
                columns = [
                    rows.column("doc_id").take(pa.array(doc)),
                    pa.array(made + np.arange(len(doc))),
                    pa.array(piece),
                    pa.array(start),
                    pa.array(length),
                    pa.array(crcs, pa.int64()),
                ]
                made += len(doc)
                if with_ids:
                    packed = ids.astype(kind)
                    ends = np.concatenate([[0], np.cumsum(length)]) * packed.itemsize
                    buffers = [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(packed)]
                    columns.append(pa.Array.from_buffers(pa.binary(), len(length), buffers))
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)
        release()

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, schema)


def pack_documents(
    docs: DataFrame,
    vocabulary: str | None = None,
    capacity: int = CAPACITY,
    end_id: int = END_ID,
    lot_size: int = LOT,
    with_ids: bool = False,
    remembered: int = REMEMBERED,
) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32, sequence_id, offset`` for every piece (and
    ``ids``). Sequences are filled from 0 without gaps."""
    pieces = cut(cut_pieces(docs, vocabulary, capacity, end_id, with_ids, remembered), "pieces")
    keys = pieces.select("uid", "length")
    first = cut(pack(keys, capacity, lot_size), "places")
    loose = F.col("fill") < LOOSE * capacity
    opened = first.where(loose).join(keys, "uid").select("uid", "length")
    again = pack(cut(opened, "loose"), capacity, lot_size)

    def numbered(places: DataFrame, level: int) -> DataFrame:
        # a lot holds far fewer than 2^20 bins, and there are fewer than 2^42 lots
        number = F.shiftleft(F.col("lot"), 20) + F.col("bin") + F.lit(level << 62)
        return places.select("uid", number.alias("sequence_id"), "offset")

    places = numbered(first.where(~loose), 0).unionByName(numbered(again, 1))
    return pieces.join(places, "uid").drop("uid")
