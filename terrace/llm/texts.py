"""Texts inside tasks: Arrow columns as bytes, in pieces of bounded size, and unused column names."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

#: Bytes of text that a task works on at once; a longer text makes a piece of its own.
PIECE_BYTES = 1 << 20


def free_name(df: DataFrame, wanted: str) -> str:
    """`wanted`, with underscores after it as long as `df` has a column of that name in any case."""
    taken = {c.lower() for c in df.columns}
    while wanted.lower() in taken:
        wanted += "_"
    return wanted


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string or binary column and where each value starts and ends; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    wide = pa.large_binary()
    column = column.cast(wide) if column.type != wide else column
    if column.null_count:
        column = column.fill_null(b"")
    _, offsets, data = column.buffers()
    ends = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1]
    if data is None or len(ends) == 0:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[ends[0]:ends[-1]], ends - ends[0]


def values(column: pa.Array) -> list[bytes]:
    """Each value's bytes; null is empty."""
    data, at = utf8(column)
    whole, at = data.tobytes(), at.tolist()
    return [whole[a:b] for a, b in zip(at, at[1:])]


def pieces(batches: Iterator[pa.RecordBatch], column: str,
           limit: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches cut where the bytes of `column` pass `limit`. Empty batches are left out."""
    for batch in batches:
        _, at = utf8(batch.column(column))
        start = 0
        while start < batch.num_rows:
            stop = int(np.searchsorted(at, at[start] + limit, side="right")) - 1
            stop = min(max(stop, start + 1), batch.num_rows)
            yield batch.slice(start, stop - start)
            start = stop
    give_back()


def give_back() -> None:
    """Returns memory that is free to the system: a worker may stay on idle beside others."""
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
        trim(0)


def giving_back(run):
    """A task's function that returns free memory when its rows have ended."""
    def wrapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        give_back()
    return wrapped


def per_value(flags: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Sums of `flags` (one for each byte or word) between neighbouring offsets."""
    total = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=total[1:])
    return total[at[1:]] - total[at[:-1]]
