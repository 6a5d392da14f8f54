"""Arrow batches in small slices, so that a task holds Python objects for a few rows at a time however large Spark's batches are."""

from __future__ import annotations

import ctypes
import functools
from collections.abc import Iterator

import pyarrow as pa

ROWS = 128


def slices(batches: Iterator[pa.RecordBatch], rows: int = ROWS) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(0, batch.num_rows, rows):
            yield batch.slice(i, rows)


def each_row(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """One row at a time, for rows that are large themselves."""
    for batch in slices(batches, 1):
        yield batch.to_pylist()[0]


def give_back() -> None:
    """Hand freed memory back to the system: workers live on from task to task, and what they keep adds up in an executor."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def releasing(run):
    """`run` over batches, with its memory given back when the task is done with it."""
    @functools.wraps(run)
    def wrapped(batches):
        try:
            yield from run(batches)
        finally:
            give_back()
    return wrapped
