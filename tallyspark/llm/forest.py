"""Approximate nearest neighbours by inner product: a hash-prefix forest.

A tree gives every vector a long hash string, one bit for each of its random hyperplanes, and keeps the strings sorted. A query descends
each tree to its longest common prefix; then all trees ascend together, one bit at a time, until the vectors below the reached prefixes,
counted over all trees, are `share` times the number of rows (so the depth varies with the query), and at least k of them, or all there
are, are distinct rows of another id. These candidates are scored exactly.

The index is a table: rows are dealt into slabs of bounded size by a hash of the id, and each slab has its vectors and, per tree, the sorted
strings and their rows. Every row is indexed; only the hyperplanes are drawn, from a seed. A search takes two passes: first each slab
counts, for each query of a block, the vectors below each prefix length, over all trees and (for k distinct rows) in its fullest tree,
and the sums over slabs give the depth where that query stops, at 0 with all rows; then each slab scores what lies below it. Identical vectors share their strings but not their slab, so none is large.

Inner products rank by angle only if all vectors have the same length, so data vectors get one more component that makes them so, and
queries a zero there. Hyperplanes are drawn in that space. With unstructured vectors most rows are about as near as the nearest, so a
high share is needed for a recall of 0.9: see the README for figures.

Nulls and odd input: rows with a null id, a null or zero vector, or null or non-finite components take no part; vectors of different
lengths are compared over the components both have; rows with the query's own id are no candidates; identical vectors tie and go by id;
an empty table gives an empty result; other columns are not read. Scores are exactly rounded sums of the doubles' products.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..session import cut_lineage
from .vectors import BLOCK_ROWS, TopK, matrix, meet, stream, unpack, usable

TREES = 16
BITS = 32
SHARE = 1.2
SLAB_ROWS = 8192
SEED = 10
ROW = "slab bigint, kind int, block bigint, ids binary, vectors binary, extra binary"
COUNTS = "block bigint, slab bigint, counts binary, others binary"
DEPTHS = "block bigint, depths binary"
RESULT = "query_id bigint, rank int, vec_id bigint, score double"
_ROW = pa.schema([("slab", pa.int64()), ("kind", pa.int32()), ("block", pa.int64()), ("ids", pa.binary()), ("vectors", pa.binary()), ("extra", pa.binary())])


def planes(width: int, trees: int = TREES, bits: int = BITS, seed: int = SEED) -> np.ndarray:
    return np.random.default_rng(seed).standard_normal((trees, bits, width))


def strings(vectors: np.ndarray, hyperplanes: np.ndarray) -> np.ndarray:
    """(tree, row): the hash strings as numbers, first bit highest."""
    trees, bits, width = hyperplanes.shape
    side = (vectors @ hyperplanes.reshape(-1, width).T > 0).reshape(len(vectors), trees, bits)
    return (side * (1 << np.arange(bits - 1, -1, -1, dtype=np.uint64))).sum(2, dtype=np.uint64).T


def lengthened(vectors: np.ndarray, longest: float) -> np.ndarray:
    """With one more component, after which all vectors are as long as the longest."""
    rest = np.maximum(longest ** 2 - (vectors ** 2).sum(1), 0)
    return np.c_[vectors, np.sqrt(rest)]


def prefix_range(ordered: np.ndarray, codes: np.ndarray, depth, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Where the strings that share their first `depth` bits with each code begin and end in the sorted array."""
    free = np.uint64(bits) - np.asarray(depth, np.uint64)
    low = (codes >> free) << free
    high = low + ((np.uint64(1) << free) - np.uint64(1))
    return np.searchsorted(ordered, low, "left"), np.searchsorted(ordered, high, "right")


def opened(row: dict, width: int, trees: int):
    """(ids, vectors, sorted strings per tree, their rows) of a slab."""
    ids, x = unpack(row["ids"], row["vectors"], width)
    cut = trees * len(ids) * 8
    return ids, x, np.frombuffer(row["extra"][:cut], np.uint64).reshape(trees, -1), np.frombuffer(row["extra"][cut:], np.int32).reshape(trees, -1)


class HashForest:
    """The index of `vectors`; `search` finds the nearest rows of queries."""

    def __init__(self, vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", trees: int = TREES, bits: int = BITS,
                 slab_rows: int = SLAB_ROWS, seed: int = SEED):
        self.id_col, self.vector_col, self.bits, self.trees = id_col, vector_col, bits, trees
        data = usable(vectors, id_col, vector_col, False)
        length = F.sqrt(F.aggregate("vector", F.lit(0.0), lambda a, x: a + x * x))
        facts = data.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("vector")).alias("d"), F.max(length).alias("longest")).first()
        self.rows, self.width, self.longest = facts["n"], facts["d"] or 1, facts["longest"] or 0.0
        self.slabs = max(1, -(-self.rows // slab_rows))
        self.planes = planes(self.width + 1, trees, bits, seed)
        width, longest, hyperplanes = self.width, self.longest, self.planes

        def index(table: pa.Table) -> pa.Table:
            x, ids = matrix(table["vector"], width), table["vec_id"].to_numpy()
            first = np.argsort(ids, kind="stable")
            x, ids = x[first], ids[first]
            codes = strings(lengthened(x, longest), hyperplanes)
            order = np.argsort(codes, axis=1, kind="stable")
            ordered = np.take_along_axis(codes, order, 1).astype(np.uint64)
            return pa.Table.from_pylist([{"slab": table["slab"][0].as_py(), "kind": 0, "block": 0, "ids": ids.tobytes(), "vectors": x.tobytes(),
                                          "extra": ordered.tobytes() + order.astype(np.int32).tobytes()}], schema=_ROW)

        slab = F.pmod(F.xxhash64(F.lit("slab"), F.col("vec_id"), F.monotonically_increasing_id()), F.lit(self.slabs)).cast("bigint")
        self.index = cut_lineage(data.withColumn("slab", slab).groupBy("slab").applyInArrow(index, ROW), "forest")

    def search(self, queries: DataFrame, k: int = 20, share: float = SHARE) -> DataFrame:
        """(query_id, rank, vec_id, score): up to k rows of another id for each query, nearest first."""
        asked = usable(queries, self.id_col, self.vector_col, False)
        if not self.rows:
            return queries.sparkSession.createDataFrame([], RESULT)
        width = max(self.width, asked.agg(F.max(F.size("vector"))).first()[0] or 0)
        own, bits, trees, hyperplanes, rows, slabs = self.width, self.bits, self.trees, self.planes, self.rows, self.slabs

        def pack(batches):
            number = 0
            for batch in batches:
                q, ids = matrix(batch.column(1), width)[:, :own], batch.column(0).to_numpy()
                base = batch.column(2)[0].as_py() << 32 if batch.num_rows else 0
                for i in range(0, len(q), BLOCK_ROWS):
                    yield pa.RecordBatch.from_pylist([{"slab": 0, "kind": 1, "block": base + number, "ids": ids[i:i + BLOCK_ROWS].tobytes(),
                                                       "vectors": np.ascontiguousarray(q[i:i + BLOCK_ROWS]).tobytes(), "extra": b""}], schema=_ROW)
                    number += 1

        blocks = cut_lineage(asked.select("vec_id", "vector", F.spark_partition_id().cast("bigint").alias("p")).mapInArrow(pack, ROW), "forest-queries")
        everywhere = F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(slabs - 1).cast("bigint"))).alias("slab")

        def spread(frame):
            return frame.select(everywhere, "kind", "block", "ids", "vectors", "extra")

        def codes_of(q):
            return strings(np.c_[q, np.zeros(len(q))], hyperplanes)

        def count(batches):
            slab = None
            for row in stream(batches):
                if row["kind"] == 0:
                    slab = opened(row, own, trees)
                    continue
                names, q = unpack(row["ids"], row["vectors"], own)
                found, most = np.zeros((len(q), bits + 1), np.int64), np.zeros((len(q), bits + 1), np.int64)
                for tree, codes in enumerate(codes_of(q)):
                    for depth in range(bits + 1):
                        low, high = prefix_range(slab[2][tree], codes, depth, bits)
                        found[:, depth] += high - low
                        most[:, depth] = np.maximum(most[:, depth], high - low)
                        if depth and not (high > low).any():
                            break
                # one tree's rows are distinct; wherever the query's own rows may lie, these many others are there at least
                mine = np.searchsorted(slab[0], names, "right") - np.searchsorted(slab[0], names, "left")
                others = np.clip(most - mine[:, None], 0, k).astype(np.int32)
                yield pa.RecordBatch.from_pydict({"block": [row["block"]], "slab": [row["slab"]], "counts": [found.tobytes()], "others": [others.tobytes()]})

        def ascend(batches):
            """Deepest length at which all trees together hold enough, and k other rows or all; the counts of a block's slabs come one after the other."""
            block, total, others = None, None, None

            def done():
                distinct = others.reshape(-1, bits + 1)
                enough = (total.reshape(-1, bits + 1) >= min(share * rows, trees * rows)) & (distinct >= np.minimum(k, distinct[:, :1]))
                return pa.RecordBatch.from_pydict({"block": [block], "depths": [(bits - enough[:, ::-1].argmax(1)).astype(np.int8).tobytes()]})

            for row in stream(batches):
                if row["block"] != block:
                    if block is not None:
                        yield done()
                    block, total, others = row["block"], 0, 0
                total = total + np.frombuffer(row["counts"], np.int64)
                others = others + np.frombuffer(row["others"], np.int32).astype(np.int64)
            if block is not None:
                yield done()

        def score(batches):
            slab = None
            for row in stream(batches):
                if row["kind"] == 0:
                    slab = opened(row, own, trees)
                    continue
                ids, x, ordered, order = slab
                names, q = unpack(row["ids"], row["vectors"], own)
                depths = np.frombuffer(row["extra"], np.int8).astype(np.int64)
                chosen = np.zeros((len(q), len(ids)), bool)
                for tree, codes in enumerate(codes_of(q)):
                    low, high = prefix_range(ordered[tree], codes, depths, bits)
                    for i in range(len(q)):
                        chosen[i, order[tree, low[i]:high[i]]] = True
                chosen &= names[:, None] != ids
                near = np.where(chosen, q @ x.T, -np.inf)
                least = np.partition(near, -k, axis=1)[:, -k] if near.shape[1] > k else np.full(len(q), -np.inf)
                slack = 1e-9 * np.abs(least, where=np.isfinite(least), out=np.zeros(len(q))) + 1e-12
                r, c = np.nonzero(chosen & (near >= (least - slack)[:, None]))
                best = TopK(len(q), k)
                best.add(r, ids[c], np.array([math.fsum((q[i] * x[j]).tolist()) for i, j in zip(r.tolist(), c.tolist())], np.float64))
                yield pa.RecordBatch.from_pydict({"block": [row["block"]], "slab": [row["slab"]], "ids": [row["ids"]], "rows": [best.row.tobytes()],
                                                  "found": [best.id.tobytes()], "scores": [best.score.tobytes()]})

        def merge(batches):
            block, names, best = None, None, None

            def done():
                return pa.RecordBatch.from_pydict({"query_id": names[best.row], "rank": best.ranks().astype(np.int32), "vec_id": best.id, "score": best.score})

            for row in stream(batches):
                if row["block"] != block:
                    if block is not None:
                        yield done()
                    block, names = row["block"], np.frombuffer(row["ids"], np.int64)
                    best = TopK(len(names), k)
                best.add(*(np.frombuffer(row[c], t) for c, t in (("rows", np.int64), ("found", np.int64), ("scores", np.float64))))
            if block is not None:
                yield done()

        counts = meet([self.index, spread(blocks)], "slab", ["kind", "block"]).mapInArrow(count, COUNTS)
        depths = counts.repartition("block").sortWithinPartitions("block", "slab").mapInArrow(ascend, DEPTHS)
        deep = blocks.drop("extra").join(depths.withColumnRenamed("depths", "extra"), "block")
        scored = meet([self.index, spread(deep)], "slab", ["kind", "block"]).mapInArrow(
            score, "block bigint, slab bigint, ids binary, rows binary, found binary, scores binary")
        return scored.repartition("block").sortWithinPartitions("block", "slab").mapInArrow(merge, RESULT)
