"""What the two vector searches share: usable vectors, blocks of vectors as binary rows, exact top-k in blocks, streamed meetings of blocks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

#: Queries come in blocks of at most so many rows.
BLOCK_ROWS = 512


def usable(vectors: DataFrame, id_col: str, vector_col: str, zero_too: bool) -> DataFrame:
    """(vec_id, vector as doubles) of the rows that take part: an id, and a vector without null or non-finite components."""
    rows = vectors.select(F.col(id_col).cast("bigint").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("vector"))
    rows = rows.where(F.col("vec_id").isNotNull() & F.col("vector").isNotNull())
    rows = rows.where(F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))))
    return rows if zero_too else rows.where(F.exists("vector", lambda x: x != 0))


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """A list column as a matrix; shorter vectors are filled up with zeros, which leaves inner products as they are."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    sizes = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    if (sizes == width).all():
        return flat.reshape(-1, width)
    out = np.zeros((len(column), width))
    row = np.repeat(np.arange(len(sizes)), sizes)
    out[row, np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    return out


def unpack(ids: bytes, vectors: bytes, width: int) -> tuple[np.ndarray, np.ndarray]:
    names = np.frombuffer(ids, np.int64)
    return names, np.frombuffer(vectors, np.float64).reshape(len(names), width)


def doubles(scores: np.ndarray) -> np.ndarray:
    """Scores as doubles; whole numbers beyond them become infinite."""
    if scores.dtype != object:
        return scores.astype(np.float64)
    flat = [float(s) if -2 ** 1023 < s < 2 ** 1023 else np.inf if s > 0 else -np.inf for s in scores.ravel()]
    return np.array(flat, np.float64).reshape(scores.shape)


class TopK:
    """The k best (score, then smaller id) of each row, kept while blocks of candidates pass by."""

    def __init__(self, rows: int, k: int, least: np.ndarray | None = None, kind=np.float64):
        self.k = k
        self.row, self.id, self.score = np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, kind)
        #: A score that the k-th best is known to reach; ties count.
        self.least = np.full(rows, -np.inf) if least is None else least.astype(np.float64).copy()

    def add(self, row: np.ndarray, ids: np.ndarray, score: np.ndarray) -> None:
        row, ids, score = np.r_[self.row, row], np.r_[self.id, ids], np.r_[self.score, score]
        order = np.lexsort((ids, -score, row)) if score.dtype != object else np.array(
            sorted(range(len(row)), key=lambda i: (row[i], -score[i], ids[i])), np.int64)
        row, ids, score = row[order], ids[order], score[order]
        rank = np.arange(len(row)) - np.searchsorted(row, row)
        keep = rank < self.k
        self.row, self.id, self.score = row[keep], ids[keep], score[keep]
        full = np.flatnonzero(rank == self.k - 1)
        self.least[row[full]] = np.maximum(self.least[row[full]], doubles(score[full]))

    def ranks(self) -> np.ndarray:
        return np.arange(len(self.row)) - np.searchsorted(self.row, self.row) + 1


def meet(sides: list[DataFrame], key: str, order: list[str]) -> DataFrame:
    """Rows of several frames of one schema, dealt out by `key` and within it in the given order, to be read as a stream.

    The first rows of a key are what the later ones are compared with; no task holds more than these and one row.
    """
    every = sides[0]
    for side in sides[1:]:
        every = every.unionByName(side)
    return every.repartition(key).sortWithinPartitions(key, *order)


def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield {name: batch.column(j)[i].as_py() for j, name in enumerate(batch.schema.names)}
