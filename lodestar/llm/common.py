"""Helpers shared by the operators of this package: derived tables in the
shared folder, Arrow text buffers, counter-based random numbers."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import SparkSession

from ..session import materialize, release

__all__ = ["bounded_batches", "materialize", "mix64", "release", "row_slices", "text_bytes", "unit"]


def bounded_batches(spark: SparkSession, rows: int = 1000, size: int = 32 << 20) -> None:
    """Whole texts can be long, so a session that runs these operators gets
    Arrow batches of fewer rows than the default, and of ``size`` bytes (one
    row at least)."""
    for key, most in (("spark.sql.execution.arrow.maxRecordsPerBatch", rows),
                      ("spark.sql.execution.arrow.maxBytesPerBatch", size)):
        if not 0 < int(spark.conf.get(key).rstrip("b")) <= most:
            spark.conf.set(key, str(most))


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column and its len+1 offsets, without making a
    Python string per row; nulls are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    n = len(column)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, np.int64)[column.offset:column.offset + n + 1]
    raw = np.frombuffer(data, np.uint8)[off[0]:off[-1]] if data is not None else np.zeros(0, np.uint8)
    return raw, off - off[0]


def row_slices(offsets: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``most`` bytes of text each (one row at least)."""
    start, n = 0, len(offsets) - 1
    while start < n:
        end = int(np.searchsorted(offsets, offsets[start] + most, side="right")) - 1
        end = min(n, max(end, start + 1))
        yield start, end
        start = end


_GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def mix64(x: np.ndarray) -> np.ndarray:
    """SplitMix64's finalizer on uint64 values."""
    with np.errstate(over="ignore"):
        x = (x + _GOLDEN).astype(np.uint64, copy=False)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def unit(x: np.ndarray) -> np.ndarray:
    """uint64 hashes as doubles strictly between 0 and 1."""
    return ((x >> np.uint64(12)).astype(np.float64) + 0.5) * 2.0 ** -52
