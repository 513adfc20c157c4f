"""Operator 1: token ids in patched frame-of-reference blocks.

A *segment* holds the ids of a run of documents, little-endian throughout:

- ``PFB1``, then unsigned 64-bit: documents, ids, blocks;
- for each document its id (64-bit), whether it has one (8-bit) and its number of ids (64-bit);
- the block index: where each block starts behind the index, and the end (64-bit each);
- the blocks, 128 ids each, the last one padded with its minimum: minimum (32-bit), bit width (8-bit),
  number of exceptions (8-bit), the differences to the minimum packed at the width, lowest bit first,
  then the exceptions: places (8-bit) and whole differences (32-bit).

The width is that of the ``PERCENTILE``-th percentile of a block's differences, so a few large ids
don't widen a block; they are its exceptions. The index lets a reader decode one block alone.

Segments are the binary column of a table that Spark writes, so any store that Spark writes to will
do and a lost executor leaves no half-written file. Rows are ranged by document id; the number
of ids before a segment comes from sums by file part, so no task sees all documents.

NULL texts count as empty and are encoded as the end id alone. NULL document ids come first.
Documents of one id keep all their rows, ordered by text hash. An empty table gives no segment.
Columns other than ``doc_id`` and ``text`` are ignored.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T

from ledgerline.llm.arrow import chunks, release
from ledgerline.llm.tables import checked_broadcast, long_field, partition_starts
from ledgerline.llm.tokens import REMEMBERED_ALONE, encoder, vocabulary_path

BLOCK = 128
PERCENTILE = 90
END_ID = 2
MAGIC = b"PFB1"
#: Bytes of text that one segment is made of; a longer text is a segment of its own.
SEGMENT_BYTES = 1 << 20

_SEGMENT = T.StructType(
    [
        *long_field("part", "segment", "n_docs", "n_ids"),
        T.StructField("data", T.BinaryType()),
    ]
)


def _bit_length(x: np.ndarray) -> np.ndarray:
    return np.ceil(np.log2(x.astype(np.float64) + 1)).astype(np.int64)


def encode_blocks(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The blocks of unsigned 32-bit ids as bytes, and where each starts (and the last ends)."""
    n = -(-len(ids) // BLOCK)
    if not n:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    padded = np.full(n * BLOCK, ids[(n - 1) * BLOCK :].min(), np.uint32)
    padded[: len(ids)] = ids
    rows = padded.reshape(n, BLOCK)
    low = rows.min(axis=1)
    rows = rows - low[:, None]
    rank = BLOCK * PERCENTILE // 100
    width = _bit_length(np.partition(rows, rank, axis=1)[:, rank])
    patched = (rows.astype(np.uint64) >> width[:, None].astype(np.uint64)) > 0
    n_patched = patched.sum(axis=1)
    size = 6 + BLOCK // 8 * width + 5 * n_patched
    start = np.concatenate([[0], np.cumsum(size)])
    out = np.zeros(start[-1], np.uint8)
    at = start[:-1]
    out[at[:, None] + np.arange(4)] = low.astype("<u4").view(np.uint8).reshape(n, 4)
    out[at + 4] = width
    out[at + 5] = n_patched
    for w in np.unique(width[width > 0]):
        own = np.flatnonzero(width == w)
        bits = (rows[own][:, :, None] >> np.arange(w, dtype=np.uint32)) & 1
        packed = np.packbits(bits.astype(np.uint8).reshape(len(own), -1), axis=1, bitorder="little")
        out[at[own][:, None] + 6 + np.arange(packed.shape[1])] = packed
    block, place = np.nonzero(patched)
    nth = np.arange(len(block)) - np.repeat(np.cumsum(n_patched) - n_patched, n_patched)
    first = at[block] + 6 + BLOCK // 8 * width[block]
    out[first + nth] = place
    values = rows[block, place].astype("<u4").view(np.uint8).reshape(-1, 4)
    out[(first + n_patched[block] + 4 * nth)[:, None] + np.arange(4)] = values
    return out, start


def decode_blocks(data: np.ndarray, start: np.ndarray) -> np.ndarray:
    """The ids of the blocks that start at ``start`` (all but its last value), padding included."""
    at = start[:-1]
    n = len(at)
    low = np.ascontiguousarray(data[at[:, None] + np.arange(4)]).view("<u4").reshape(n)
    width, n_patched = data[at + 4].astype(np.int64), data[at + 5].astype(np.int64)
    rows = np.zeros((n, BLOCK), np.uint32)
    for w in np.unique(width[width > 0]):
        own = np.flatnonzero(width == w)
        packed = data[at[own][:, None] + 6 + np.arange(BLOCK // 8 * w)]
        bits = np.unpackbits(packed, axis=1, bitorder="little").reshape(len(own), BLOCK, w)
        total = np.zeros((len(own), BLOCK), np.uint32)
        for k in range(w):
            total |= bits[:, :, k].astype(np.uint32) << np.uint32(k)
        rows[own] = total
    block = np.repeat(np.arange(n), n_patched)
    nth = np.arange(len(block)) - np.repeat(np.cumsum(n_patched) - n_patched, n_patched)
    first = at[block] + 6 + BLOCK // 8 * width[block]
    spots = (first + n_patched[block] + 4 * nth)[:, None] + np.arange(4)
    values = np.ascontiguousarray(data[spots]).view("<u4").reshape(len(block))
    rows[block, data[first + nth]] = values
    return (rows + low[:, None]).reshape(-1)


def pack_segment(doc_ids: pa.Array, ids: np.ndarray, bounds: np.ndarray) -> bytes:
    blocks, start = encode_blocks(ids)
    named = np.array([x is not None for x in doc_ids.to_pylist()], np.uint8)
    return b"".join(
        [
            MAGIC,
            struct.pack("<QQQ", len(doc_ids), len(ids), len(start) - 1),
            np.array(doc_ids.fill_null(0), dtype="<i8").tobytes(),
            named.tobytes(),
            np.diff(bounds).astype("<u8").tobytes(),
            start.astype("<u8").tobytes(),
            blocks.tobytes(),
        ]
    )


class Segment:
    """Reads a segment: ``doc_ids``, ``bounds`` of the documents, ``ids()`` and ``block(k)``."""

    def __init__(self, data: bytes):
        if data[:4] != MAGIC:
            raise ValueError("not a segment of token ids")
        self.n_docs, self.n_ids, n_blocks = struct.unpack_from("<QQQ", data, 4)
        at = 28
        ids = np.frombuffer(data, "<i8", self.n_docs, at)
        at += 8 * self.n_docs
        named = np.frombuffer(data, np.uint8, self.n_docs, at)
        self.doc_ids = [int(i) if k else None for i, k in zip(ids, named, strict=True)]
        at += self.n_docs
        sizes = np.frombuffer(data, "<u8", self.n_docs, at).astype(np.int64)
        self.bounds = np.concatenate([[0], np.cumsum(sizes)])
        at += 8 * self.n_docs
        self.start = np.frombuffer(data, "<u8", n_blocks + 1, at).astype(np.int64)
        self.data = np.frombuffer(data, np.uint8, offset=at + 8 * (n_blocks + 1))

    def ids(self) -> np.ndarray:
        return decode_blocks(self.data, self.start)[: self.n_ids]

    def block(self, k: int) -> np.ndarray:
        """The ids of one block, found by the index and decoded alone."""
        return decode_blocks(self.data, self.start[k : k + 2])[: self.n_ids - k * BLOCK]


def write_tokens(
    docs: DataFrame, path: str, vocabulary: str | None = None, end_id: int = END_ID
) -> None:
    """Write the ids of all texts as segments, documents in ascending order of their id."""
    vocabulary = vocabulary or vocabulary_path()
    schema = pa.schema(
        [pa.field(n, pa.int64()) for n in _SEGMENT.names[:4]] + [pa.field("data", pa.binary())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, segment = TaskContext.get().partitionId(), 0
        model = encoder(vocabulary, REMEMBERED_ALONE)
        for batch in batches:
            for rows in chunks(batch, "text", SEGMENT_BYTES):
                ids, bounds = model.encode(rows.column("text"), end_id)
                doc_ids = rows.column("doc_id")
                row = [part, segment, len(doc_ids), len(ids), pack_segment(doc_ids, ids, bounds)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([v], f.type) for v, f in zip(row, schema, strict=True)], schema=schema
                )
                segment += 1
        release()

    (
        docs.select(F.col("doc_id").cast("long"), "text")
        .repartitionByRange(F.col("doc_id").asc_nulls_first())
        .sortWithinPartitions(F.col("doc_id").asc_nulls_first(), F.xxhash64("text"))
        .mapInArrow(run, _SEGMENT)
        .write.parquet(path)
    )


def segment_starts(segments: DataFrame) -> DataFrame:
    """The number of ids before each segment, from sums by part."""
    slim = segments.select("part", "segment", "n_ids")
    before = Window.partitionBy("part").orderBy("segment").rowsBetween(Window.unboundedPreceding, -1)
    inside = slim.withColumn("inside", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))
    starts = partition_starts(slim, "part", ["n_ids"])
    return inside.join(starts, "part").select(
        "part", "segment", (F.col("inside") + F.col("n_ids_before")).alias("first")
    )


def read_tokens(spark: SparkSession, path: str, with_ids: bool = True) -> DataFrame:
    """One row for each document: ``doc_id``, ``start`` (ids before it in the whole file),
    ``n_tokens``, ``ids_crc32`` and, if asked for, ``ids``."""
    segments = spark.read.schema(_SEGMENT).parquet(path)
    starts = checked_broadcast(segment_starts(segments))
    fields = long_field("doc_id", "start", "n_tokens", "ids_crc32")
    if with_ids:
        fields.append(T.StructField("ids", T.ArrayType(T.LongType())))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for data, first in zip(batch.column("data"), batch.column("first"), strict=True):
                segment = Segment(data.as_buffer().to_pybytes())
                ids = np.ascontiguousarray(segment.ids(), "<u4")
                raw, ends = memoryview(ids.tobytes()), segment.bounds
                crcs = [
                    zlib.crc32(raw[4 * a : 4 * b])
                    for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)
                ]
                columns = [
                    pa.array(segment.doc_ids, pa.int64()),
                    pa.array(ends[:-1] + first.as_py()),
                    pa.array(np.diff(ends)),
                    pa.array(crcs, pa.int64()),
                ]
                if with_ids:
                    columns.append(
                        pa.ListArray.from_arrays(ends.astype(np.int32), ids.astype(np.int64))
                    )
                yield pa.RecordBatch.from_arrays(columns, names=[f.name for f in fields])

    joined = segments.join(starts, ["part", "segment"]).select("data", "first")
    return joined.mapInArrow(run, T.StructType(fields))
