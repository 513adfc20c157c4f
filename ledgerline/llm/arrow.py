"""Whole texts as byte arrays inside tasks, and operators that append columns to any table."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

#: Bytes of text a task works on at once. A longer text is still worked on whole, alone.
CHUNK_BYTES = 256 << 10


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a text column, end to end, and where each text starts and ends.
    NULL counts as an empty text."""
    if column.null_count:
        column = column.fill_null("")
    _, offsets, data = column.buffers()
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    bounds = np.frombuffer(offsets, kind)[column.offset : column.offset + len(column) + 1]
    bounds = bounds.astype(np.int64)
    if data is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[bounds[0] : bounds[-1]], bounds - bounds[0]


def chunks(
    batch: pa.RecordBatch, column: str, size: int = CHUNK_BYTES
) -> Iterator[pa.RecordBatch]:
    """Cut a batch so that the texts of a part come to ``size`` bytes at most, or are one text."""
    if not batch.num_rows:
        return
    _, bounds = text_bytes(batch.column(column))
    first = 0
    while first < batch.num_rows:
        last = int(np.searchsorted(bounds, bounds[first] + size, "right")) - 1
        last = min(max(last, first + 1), batch.num_rows)
        yield batch.slice(first, last - first)
        first = last


def release() -> None:
    """Give memory that is no longer used back to the system, as Spark keeps workers for later stages."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # not glibc
        pass


def per_text(
    df: DataFrame, column: str, schema: T.StructType, work: Callable[[pa.RecordBatch], dict]
) -> DataFrame:
    """Rows that ``work`` makes of each part of the table, of any number."""
    target = pa_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, column):
                made = work(part)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(made[f.name], f.type) for f in target], schema=target
                )
        release()

    return df.mapInArrow(run, schema)


def append_columns(
    df: DataFrame, column: str, schema: T.StructType, work: Callable[[pa.RecordBatch], dict]
) -> DataFrame:
    """The table with the columns of ``schema`` after its own; columns of the same names are
    replaced. ``work`` returns a value for each row of its part."""
    kept = [name for name in df.columns if name not in schema.names or name == column]
    added = [f for f in schema.fields if f.name not in kept]
    df = df.select(*(F.col(f"`{name}`") for name in kept))
    target = T.StructType([*df.schema.fields, *added])
    arrow = pa_schema(T.StructType(added))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, column):
                made = work(part)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, *(pa.array(made[f.name], f.type) for f in arrow)],
                    names=[*part.schema.names, *arrow.names],
                )
        release()

    return df.mapInArrow(run, target)


_ARROW = {
    T.LongType: pa.int64(),
    T.IntegerType: pa.int32(),
    T.DoubleType: pa.float64(),
    T.StringType: pa.string(),
    T.BinaryType: pa.binary(),
    T.BooleanType: pa.bool_(),
}


def pa_schema(schema: T.StructType) -> pa.Schema:
    def kind(data: T.DataType) -> pa.DataType:
        if isinstance(data, T.ArrayType):
            return pa.list_(kind(data.elementType))
        return _ARROW[type(data)]

    return pa.schema([pa.field(f.name, kind(f.dataType)) for f in schema.fields])
