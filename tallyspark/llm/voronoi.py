"""Exact top-k inner products by a Voronoi join: queries and data are both grouped by their nearest pivot.

Pivots are the centres of a bounded sample; their number grows with the root of the rows. Every row goes to the cell of its nearest pivot,
and cells are summarised: a query cell by its radius r (its farthest query), a data cell by its radius R, its longest vector N and the
distances of the k + 1 rows nearest to its pivot. With q = p + u, |u| <= r, and x = c + v, |v| = d, the product q.x is at least
p.c - r |c| - (|p| + r) d and at most p.x + r |x| <= p.c + |p| R + r N. The k + 1 best lower bounds of different ids give a score that the
k-th best of every query of the cell reaches (one of the ids may be the query's own); the sample, whose rows are candidates too, raises it.
Cell pairs whose upper bound stays below are dropped by the summaries alone, and a row goes to a group of neighbouring query cells only
where its own upper bound reaches one of them. What stays away cannot be among the k best.

Query cells form groups of about `BLOCK_ROWS` queries, data cells slices of about `SLICE_ROWS` rows; larger cells are split by a hash. A
task solves a group with a slice while the rows stream past, and the k best of the slices are merged.

Scores are exact integers: components are floor(64 * x); products that doubles might round are multiplied as whole numbers, and scores
beyond 64 bits stop at their limits. Nulls and odd input: rows with a null id, a null vector, or null or non-finite components (also
once multiplied by 64) take no part; an empty vector scores 0; vectors of different lengths are compared over the components both have;
rows with the query's own id are no candidates of it; repeated query rows are answered each; identical vectors tie and go by id; an empty
table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from ..session import cut_lineage
from .vectors import TopK, doubles, matrix, meet, stream, unpack, usable

#: Pivots: the root of the rows, between these. Summaries have a row per pivot and near row, so they are bounded as well.
FEWEST_PIVOTS, MOST_PIVOTS = 32, 1024
SAMPLE_ROWS = 4096
STEPS = 4
SCALE = 64
EXACT = 2.0 ** 53
#: Queries of a group, data rows of a slice, rows that are compared at once.
BLOCK_ROWS = 1024
SLICE_ROWS = 1 << 17
AT_ONCE = 2048
#: Bytes of a score beyond 64 bits as an unsigned number that sorts like the score.
WIDE_BYTES = 288
CELLS = "pivot int, vec_id bigint, vector binary, away double, norm double, least double, place bigint"
BLOCK = "block bigint, kind int, seq bigint, ids binary, vectors binary, least binary"
PART = "block bigint, row int, query_id bigint, vec_id bigint, score bigint, wide binary"
RESULT = "query_id bigint, rank int, vec_id bigint, score bigint"
BLOCK_SCHEMA = pa.schema([("block", pa.int64()), ("kind", pa.int32()), ("seq", pa.int64()), ("ids", pa.binary()), ("vectors", pa.binary()), ("least", pa.binary())])


def products(queries: np.ndarray, data: np.ndarray, exact: bool) -> np.ndarray:
    """Inner products of whole numbers held as doubles."""
    if exact:
        return queries @ data.T
    whole = np.vectorize(int, otypes=[object])
    return whole(queries).dot(whole(data).T) if queries.size and data.size else np.zeros((len(queries), len(data)), object)


def nearest_pivot(rows: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore", invalid="ignore"):
        return ((pivots ** 2).sum(1) - 2 * rows @ pivots.T).argmin(1)


def centres(sample: np.ndarray, n: int) -> np.ndarray:
    """A few steps of k-means from every m-th row of the sample."""
    pivots = sample[np.linspace(0, len(sample) - 1, min(n, len(sample))).astype(int)].copy()
    for _ in range(STEPS):
        nearest = nearest_pivot(sample, pivots)
        for j in np.unique(nearest):
            pivots[j] = sample[nearest == j].mean(0)
    return pivots


def packs(pivots: np.ndarray, sizes: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """(first block, number of blocks) of each cell: neighbouring small cells share a block, a cell of more than `most` rows has several."""
    parts = np.maximum(1, -(-sizes // most))
    first = np.zeros(len(sizes), np.int64)
    number = 0
    for cell in np.flatnonzero(parts > 1):
        first[cell] = number
        number += parts[cell]
    left = np.flatnonzero((parts == 1) & (sizes > 0))
    while len(left):
        left = left[np.argsort(((pivots[left] - pivots[left[0]]) ** 2).sum(1), kind="stable")]
        n = max(1, int(np.searchsorted(np.cumsum(sizes[left]), most, "right")))
        first[left[:n]] = number
        number, left = number + 1, left[n:]
    return first, parts


def cell_bounds(pivots: np.ndarray, radius: np.ndarray, near: list[tuple[int, int, float]], k: int) -> np.ndarray:
    """For each query cell the score that its queries' k-th best reach, from the rows nearest to the data cells' pivots (cell, id, distance)."""
    out = np.full(len(pivots), -np.inf)
    if not near:
        return out
    cell, ids, away = (np.array(c) for c in zip(*near))
    length = np.sqrt((pivots ** 2).sum(1))
    for i in np.flatnonzero(radius >= 0):
        with np.errstate(over="ignore", invalid="ignore"):
            along, lost = pivots[cell] @ pivots[i], radius[i] * length[cell] + (length[i] + radius[i]) * away
            least = along - lost - 1e-9 * (np.abs(along) + lost) - 0.5
        least[~np.isfinite(least)] = -np.inf
        order = np.argsort(-least, kind="stable")
        firsts = np.sort(np.unique(ids[order], return_index=True)[1])
        if len(firsts) > k:
            out[i] = least[order[firsts[k]]]
    return out


def may_reach(along: np.ndarray, more: np.ndarray, least: np.ndarray) -> np.ndarray:
    """Not provably below `least`; bounds that doubles cannot hold prove nothing."""
    with np.errstate(over="ignore", invalid="ignore"):
        size = np.abs(along) + more + np.where(np.isfinite(least), np.abs(least), 0)
        return ~(along + more + 1e-9 * size + 0.5 < least)


def exact_top_k(vectors: DataFrame, queries: DataFrame, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding", pivots: int | None = None,
                sample_rows: int = SAMPLE_ROWS, block_rows: int = BLOCK_ROWS, slice_rows: int = SLICE_ROWS) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row of `queries` the k rows of `vectors` of another id with the highest score.

    The sample (`sample_rows` rows, by a hash) and the summaries of the cells (k + 1 distances per pivot) are read to the driver.
    """
    spark = vectors.sparkSession
    # doubles from 2 ** 52 on are whole numbers, and floor() would leave 64 bits
    whole = F.transform("vector", lambda x: F.when(F.abs(x) < 2.0 ** 46, F.floor(x * SCALE).cast("double")).otherwise(x * SCALE))

    def rows_of(frame):
        return usable(frame, id_col, vector_col, True).select("vec_id", whole.alias("vector")).where(F.forall("vector", lambda x: F.abs(x) < float("inf")))

    data, asked = rows_of(vectors), rows_of(queries)
    facts_of = [F.count(F.lit(1)).alias("n"), F.max(F.size("vector")).alias("d"), F.max(F.array_max(F.transform("vector", F.abs))).alias("m")]
    facts, facts_q = data.agg(*facts_of).first(), asked.agg(*facts_of).first()
    if not facts["n"] or not facts_q["n"]:
        return spark.createDataFrame([], RESULT)
    width = max(facts["d"], facts_q["d"], 1)
    exact = (facts["m"] or 0) * (facts_q["m"] or 0) * width < EXACT
    sample, sample_ids = draw(data, facts["n"], sample_rows, width)
    p = centres(sample, pivots or min(MOST_PIVOTS, max(FEWEST_PIVOTS, math.isqrt(facts["n"]))))
    length = np.sqrt((p ** 2).sum(1))

    def cells_of(with_bound: bool):
        def cells(batches):
            place = 0
            for batch in batches:
                x, ids = matrix(batch.column(1), width), batch.column(0).to_numpy()
                for i in range(0, len(x), AT_ONCE):
                    part, names = x[i:i + AT_ONCE], ids[i:i + AT_ONCE]
                    least = np.full(len(part), -np.inf)
                    if with_bound and len(sample) >= k:
                        scores = doubles(products(part, sample, exact))
                        scores[names[:, None] == sample_ids] = -np.inf
                        least = np.partition(scores, -k, axis=1)[:, -k]
                    nearest = nearest_pivot(part, p)
                    with np.errstate(over="ignore", invalid="ignore"):
                        away, norm = np.sqrt(((part - p[nearest]) ** 2).sum(1)), np.sqrt((part ** 2).sum(1))
                    yield pa.RecordBatch.from_pydict({"pivot": nearest.astype(np.int32), "vec_id": names, "vector": [v.tobytes() for v in part], "away": away,
                                                      "norm": norm, "least": least, "place": np.arange(place, place + len(part))})
                    place += len(part)
        return cells

    query_cells = cut_lineage(asked.mapInArrow(cells_of(True), CELLS), "knn-queries")
    data_cells = cut_lineage(data.mapInArrow(cells_of(False), CELLS), "knn-data")

    # summaries of the cells, and what follows from them
    m = len(p)
    n_q, radius, known = np.zeros(m, np.int64), np.full(m, -1.0), np.full(m, -np.inf)
    for r in query_cells.groupBy("pivot").agg(F.count(F.lit(1)).alias("n"), F.max("away").alias("radius"), F.min("least").alias("least")).collect():
        n_q[r["pivot"]], radius[r["pivot"]], known[r["pivot"]] = r["n"], r["radius"], r["least"]
    n_x, reach, longest = np.zeros(m, np.int64), np.zeros(m), np.zeros(m)
    for r in data_cells.groupBy("pivot").agg(F.count(F.lit(1)).alias("n"), F.max("away").alias("reach"), F.max("norm").alias("longest")).collect():
        n_x[r["pivot"]], reach[r["pivot"]], longest[r["pivot"]] = r["n"], r["reach"], r["longest"]
    near = data_cells.select("pivot", "vec_id", "away", F.row_number().over(Window.partitionBy("pivot").orderBy("away", "vec_id")).alias("at")).where(F.col("at") <= k + 1)
    least = np.maximum(cell_bounds(p, radius, [(r["pivot"], r["vec_id"], r["away"]) for r in near.collect()], k), known)
    with np.errstate(over="ignore", invalid="ignore"):
        pairs = may_reach(p @ p.T, length[:, None] * reach + radius[:, None] * longest, least[:, None]) & (n_q > 0)[:, None] & (n_x > 0)
    group, group_parts = packs(p, n_q, block_rows)
    part, slice_parts = packs(p, n_x, slice_rows)
    slices = int((part + slice_parts).max())
    heads = np.unique(group[n_q > 0])
    member = np.array([(group == g) & (n_q > 0) for g in heads]).T
    copies = [int(group_parts[member[:, j]].max()) for j in range(len(heads))]
    slices_of = {}
    for j, g in enumerate(heads):
        met = np.flatnonzero(pairs[member[:, j]].any(0))
        wanted = sorted({int(part[c] + i) for c in met for i in range(slice_parts[c])})
        slices_of.update({int(g + i): wanted for i in range(copies[j])})

    table = spark.createDataFrame([(int(c), int(group[c]), int(group_parts[c])) for c in np.flatnonzero(n_q)], "pivot int, head bigint, parts bigint")
    numbered = query_cells.join(table, "pivot").withColumn("block", F.col("head") + F.pmod(F.xxhash64("place", "vec_id"), "parts"))

    def pack_queries(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by([("vec_id", "ascending"), ("vector", "ascending")])  # the same order in every attempt
        return pa.Table.from_pydict({"block": rows["block"][:1], "kind": pa.array([0], pa.int32()), "seq": pa.array([0], pa.int64()),
                                     "ids": [rows["vec_id"].to_numpy().tobytes()], "vectors": [b"".join(rows["vector"].to_pylist())],
                                     "least": [rows["least"].to_numpy().tobytes()]})

    def spread(batches):
        for row in stream(batches):
            for s in slices_of[row["block"]]:
                yield pa.RecordBatch.from_pylist([row | {"block": row["block"] * slices + s}], schema=BLOCK_SCHEMA)

    def deal(batches):
        seq = 0
        for batch in batches:
            cell, ids, place = (batch.column(c).to_numpy() for c in (0, 1, 6))
            x = np.frombuffer(b"".join(batch.column(2).to_pylist()), np.float64).reshape(len(ids), width)
            for i in range(0, len(x), AT_ONCE):
                rows, names, at = x[i:i + AT_ONCE], ids[i:i + AT_ONCE], cell[i:i + AT_ONCE]
                norm = batch.column(4).to_numpy()[i:i + AT_ONCE]
                with np.errstate(over="ignore", invalid="ignore"):
                    along, more = rows @ p.T, norm[:, None] * radius
                wanted = (may_reach(along, more, least) & pairs[:, at].T).astype(np.float32) @ member.astype(np.float32) > 0
                to = part[at] + place[i:i + AT_ONCE] % slice_parts[at]
                out = []
                for j, g in enumerate(heads):
                    for s in np.unique(to[wanted[:, j]]):
                        send = wanted[:, j] & (to == s)
                        row = {"kind": 1, "seq": seq, "ids": names[send].tobytes(), "vectors": rows[send].tobytes(), "least": b""}
                        out += [row | {"block": int(g + c) * slices + int(s)} for c in range(copies[j])]
                        seq += 1
                if out:
                    yield pa.RecordBatch.from_pylist(out, schema=BLOCK_SCHEMA)

    dealt = meet([numbered.groupBy("block").applyInArrow(pack_queries, BLOCK).mapInArrow(spread, BLOCK), data_cells.mapInArrow(deal, BLOCK)], "block", ["kind", "seq"])
    best_first = Window.partitionBy("block", "row").orderBy(F.col("wide").desc(), F.col("score").desc(), "vec_id")
    ranked = dealt.mapInArrow(solver(k, width, slices, exact), PART).withColumn("rank", F.row_number().over(best_first)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def draw(data: DataFrame, rows: int, sample_rows: int, width: int) -> tuple[np.ndarray, np.ndarray]:
    """A sample by hash, thinned before it is sorted. It decides which pivots there are and how much is sent, not what is found."""
    key = F.xxhash64(F.lit("sample"), "vec_id", "vector")
    thin = data.where(F.pmod(key, F.lit(1 << 40)) < int(min(1.0, 2 * sample_rows / rows) * (1 << 40)))
    drawn = thin.orderBy(key, "vec_id").limit(sample_rows).toArrow()
    if not drawn.num_rows:  # few different rows, none of which the hash has chosen
        drawn = data.limit(sample_rows).toArrow()
    return matrix(drawn["vector"], width), drawn["vec_id"].to_numpy()


def solver(k: int, width: int, slices: int, exact: bool):
    """The k best rows of a slice for each query of a group: the queries come first, then the rows."""
    def solve(batches):
        held, best, waiting = None, None, []

        def compare():
            ids, x = np.concatenate([w[0] for w in waiting]), np.concatenate([w[1] for w in waiting])
            waiting.clear()
            scores = products(held[2], x, exact)
            good = (doubles(scores) >= best.least[:, None]) & (held[1][:, None] != ids)
            r, c = np.nonzero(good)
            best.add(r, ids[c], scores[r, c])

        def done():
            if waiting:
                compare()
            scores = best.score if exact else [max(min(int(s), 2 ** 63 - 1), -2 ** 63) for s in best.score]
            wide = [None if exact else (int(s) + (1 << 8 * WIDE_BYTES - 1)).to_bytes(WIDE_BYTES, "big") for s in best.score]
            return pa.RecordBatch.from_pydict({
                "block": np.full(len(best.row), held[0] // slices), "row": best.row.astype(np.int32), "query_id": held[1][best.row], "vec_id": best.id,
                "score": np.array(scores).astype(np.int64), "wide": pa.array(wide, pa.binary())})

        for row in stream(batches):
            if row["kind"] == 0:
                if best is not None:
                    yield done()
                ids, q = unpack(row["ids"], row["vectors"], width)
                held = (row["block"], ids, q)
                best = TopK(len(ids), k, np.frombuffer(row["least"], np.float64), np.float64 if exact else object)
            elif held is not None and held[0] == row["block"]:
                waiting.append(unpack(row["ids"], row["vectors"], width))
                if sum(len(w[0]) for w in waiting) >= AT_ONCE:
                    compare()
        if best is not None:
            yield done()
    return solve
