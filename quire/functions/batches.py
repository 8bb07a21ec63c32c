"""Arrow batches in Python workers, cut by bytes so that a worker's memory does
not grow with the rows of a batch, nor with what earlier tasks left behind."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_trim = getattr(ctypes.CDLL(None), "malloc_trim", None)


def give_back() -> None:
    """Return freed memory to the system. Workers are kept for later tasks and
    several wait beside each other, so what one keeps is not there for others."""
    pa.default_memory_pool().release_unused()
    if _trim is not None:
        _trim(0)


def run_ends(sizes: np.ndarray, limit: int) -> Iterator[tuple[int, int]]:
    """(start, stop) of the runs of rows that hold about ``limit`` bytes; a
    larger row is a run by itself."""
    ends, start = np.cumsum(sizes), 0
    while start < len(ends):
        base = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, base + limit, "right")))
        yield start, stop
        start = stop


def byte_lengths(column: pa.Array) -> np.ndarray:
    return pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False)


def byte_slices(batch: pa.RecordBatch, text: int, limit: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Cut a batch into runs of rows whose texts hold about ``limit`` bytes
    (a longer text is a run by itself), so that arrays per byte stay small.
    After the last one, memory that is free goes back to the system."""
    if not batch.num_rows:
        return
    for start, stop in run_ends(byte_lengths(batch.column(text)), limit):
        yield batch.slice(start, stop - start)
    give_back()


def double_lists(rows: np.ndarray, dtype=np.float64) -> pa.Array:
    """The rows of a matrix as an Arrow list column."""
    rows = np.ascontiguousarray(rows, dtype)
    offsets = np.arange(len(rows) + 1, dtype=np.int32) * rows.shape[1]
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(rows.ravel()))
