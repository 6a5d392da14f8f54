"""SimHash near-duplicates by anchor-point covering.

A fingerprint's halves of 32 bits are looked at apart: fingerprints at three or fewer differing bits differ in at most one bit in one of
the halves. The anchors of a half are the words of a covering code: the perfect Hamming code of length 31, with the 32nd bit free. It
covers every half within radius 1. A fingerprint's home is the anchor that covers its half; it is replicated to every anchor within the
radius plus the threshold, 1 + 1, that covers some half one bit away: 16 anchors, and the home with its free bit turned. So the home of
one of a linked pair always holds the other. Only distinct fingerprints are compared, at each anchor homes against members, and what
leaves a batch is a spanning forest of the links found, never all pairs; connected components follow.

Large anchors: a batch holds one slice of an anchor's members; homes come first in an anchor, and if there are more than `HOME_BLOCK`
of them, members are compared with blocks of homes one after the other. Memory grows with the homes of one anchor, distinct values that
share 31 bits up to one difference.

Nulls and odd input: a null, empty or blank text has fingerprint zero and links like any other; with fewer words than a shingle the whole
sequence is the shingle; null ids take part and get their component's smallest id, null if it has none; repeated rows stay; an empty
table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from ..session import cut_lineage
from .batches import releasing, slices
from .components import connected_components

SEED = 42
SHINGLE_WORDS = 3
MAX_BITS = 3
HASHES_AT_ONCE = 1 << 15
HOME_BLOCK = 4096
PAIRS_AT_ONCE = 1 << 21


def fingerprint(text: str | None, words: int = SHINGLE_WORDS) -> int:
    """64 bits; a bit is set if it is set in over half of the shingles' hashes."""
    tokens = (text or "").encode("utf-8").lower().split()  # bytes: A-Z alone are lowered, and \x20, \x09-\x0d alone are white space
    if not tokens:
        return 0
    words = min(words, len(tokens))
    joined = b" ".join(tokens)
    lengths = np.fromiter(map(len, tokens), np.int64, len(tokens))
    ends = np.cumsum(lengths + 1) - 1
    starts = ends - lengths
    n = len(tokens) - words + 1
    begin, stop = starts[:n].tolist(), ends[words - 1:].tolist()
    digest, counts = xxhash.xxh64_intdigest, np.zeros(64, np.int64)
    for at in range(0, n, HASHES_AT_ONCE):
        hashes = np.array([digest(joined[s:e], SEED) for s, e in zip(begin[at:at + HASHES_AT_ONCE], stop[at:at + HASHES_AT_ONCE])], dtype=">u8")
        counts += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(counts * 2 > n).tobytes(), "big")


def fingerprints(docs: DataFrame, words: int = SHINGLE_WORDS, id_col: str = "doc_id") -> DataFrame:
    """(doc_id, text_hash, fp), fp as a signed 64-bit integer."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        for batch in slices(batches):
            values = np.array([fingerprint(t.as_py(), words) for t in batch.column(2)], dtype=np.uint64).astype(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(values)], ["doc_id", "text_hash", "fp"])

    # ids go through as text, so that null ids stay what they are
    rows = docs.select(F.col(id_col).cast("string").alias("doc_id"), F.xxhash64("text").alias("text_hash"), "text")
    rows = rows.mapInArrow(releasing(run), "doc_id string, text_hash bigint, fp bigint")
    return rows.select(F.col("doc_id").cast(kind).alias("doc_id"), "text_hash", "fp")


def syndromes(words: np.ndarray) -> np.ndarray:
    """Xor of the places (1 to 31) of the set bits below bit 31; 0 for a code word."""
    out = np.zeros(words.shape, np.uint64)
    for place in range(1, 32):
        out ^= ((words >> np.uint64(place - 1)) & np.uint64(1)) * np.uint64(place)
    return out


#: The bit of each place of the Hamming code; place 0 is no bit.
PLACE_BIT = np.array([0] + [1 << i for i in range(31)], dtype=np.uint64)
FREE_BIT = np.uint64(1 << 31)


def anchors(halves: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(home, others): the covering code word of each 32-bit half, and the other anchors a half one bit away may have as its home.

    `others` has 16 columns, of which the ones equal to home repeat it.
    """
    s = syndromes(halves)
    home = halves ^ PLACE_BIT[s.astype(np.int64)]
    others = np.empty((len(halves), 32), np.uint64)
    for place in range(1, 32):
        others[:, place - 1] = halves ^ PLACE_BIT[place] ^ PLACE_BIT[(s ^ np.uint64(place)).astype(np.int64)]
    others[:, 31] = home ^ FREE_BIT
    others.sort(axis=1)
    return home, others


def _replicas(batches):
    for batch in batches:
        fps = batch["fp"].to_numpy(np.int64).view(np.uint64)
        for half in (0, 1):
            part = (fps >> np.uint64(32 * half)) & np.uint64(0xFFFFFFFF)
            home, others = anchors(part)
            new = np.ones(others.shape, bool)
            new[:, 1:] = others[:, 1:] != others[:, :-1]
            new &= others != home[:, None]
            row, _ = np.nonzero(new)
            mark = np.uint64(half << 32)
            yield pd.DataFrame({
                "anchor": np.concatenate([home, others[new]]).__or__(mark).view(np.int64),
                "away": np.concatenate([np.zeros(len(home), np.int8), np.ones(len(row), np.int8)]),
                "fp": np.concatenate([fps, fps[row]]).view(np.int64)})


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A spanning star forest of the graph with these edges: (node, smallest node of its component)."""
    nodes, ends = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = ends[:len(a)], ends[len(a):]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[x], label[y])
        new = label.copy()
        for side in (label[x], label[y], x, y):
            np.minimum.at(new, side, low)
        new = new[new]
        if np.array_equal(new, label):
            break
        label = new
    child = np.nonzero(label != np.arange(len(nodes)))[0]
    return nodes[child], nodes[label[child]]


class _Anchor:
    """Compares members with the homes of their anchor as they come, in order of anchor and away."""

    def __init__(self, bits: int):
        self.bits, self.anchor, self.homes = bits, None, np.empty(0, np.uint64)

    def batch(self, anchor: np.ndarray, away: np.ndarray, fps: np.ndarray):
        starts = np.flatnonzero(np.r_[True, anchor[1:] != anchor[:-1]])
        counts = np.diff(np.r_[starts, len(anchor)])
        group = np.repeat(np.arange(len(starts)), counts)
        homes_in = np.bincount(group, weights=away == 0, minlength=len(starts)).astype(np.int64)
        carried = len(self.homes) if len(anchor) and self.anchor == anchor[0] else 0
        found = []
        last = len(starts) - 1
        # an anchor that began in an earlier batch or may go on in the next one, and large ones, are compared in blocks
        alone = np.zeros(len(starts), bool)
        alone[0], alone[last] = True, True
        alone |= homes_in * counts > PAIRS_AT_ONCE
        small = ~alone[group]
        found += self._small(group[small], away[small], fps[small])
        for g in np.flatnonzero(alone):
            at = slice(starts[g], starts[g] + counts[g])
            new_homes = fps[at][away[at] == 0]
            old = self.homes if g == 0 and carried else np.empty(0, np.uint64)
            homes = np.concatenate([old, new_homes])
            found += self._blocks(homes, fps[at])
            if g == last:
                self.anchor, self.homes = anchor[starts[g]], homes
        return found

    def _linked(self, a, b):
        near = (a != b) & (np.bitwise_count(a ^ b) <= self.bits)
        return [(a[near], b[near])] if near.any() else []

    def _blocks(self, homes, members):
        found = []
        for i in range(0, len(homes), HOME_BLOCK):
            h = homes[i:i + HOME_BLOCK]
            step = max(1, PAIRS_AT_ONCE // len(h))
            for j in range(0, len(members), step):
                m = members[j:j + step]
                for a, b in self._linked(np.repeat(h, len(m)), np.tile(m, len(h))):
                    found.append(tuple(x.view(np.uint64) for x in forest(a, b)))
        return found

    def _small(self, group, away, fps):
        """Homes of each group against its members, all groups at once in pieces."""
        found, starts = [], np.flatnonzero(np.r_[True, group[1:] != group[:-1]]) if len(group) else np.empty(0, np.int64)
        if not len(group):
            return found
        size = np.diff(np.r_[starts, len(group)])
        first, width = np.repeat(starts, size), np.repeat(size, size)
        home = np.flatnonzero((away == 0) & (width > 1))
        total = np.cumsum(width[home])
        cuts = np.searchsorted(total, np.arange(PAIRS_AT_ONCE, (total[-1] if len(total) else 0) + PAIRS_AT_ONCE, PAIRS_AT_ONCE), "right")
        for piece in np.split(home, np.unique(cuts[cuts < len(home)])):
            if len(piece):
                n = width[piece]
                offset = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                found += self._linked(fps[np.repeat(piece, n)], fps[np.repeat(first[piece], n) + offset])
        return found


def _compare(bits: int):
    def run(batches):
        seen = _Anchor(bits)
        for batch in batches:
            if len(batch):
                found = seen.batch(batch["anchor"].to_numpy(np.int64), batch["away"].to_numpy(), batch["fp"].to_numpy(np.int64).view(np.uint64))
                if found:
                    a, b = forest(np.concatenate([x for x, _ in found]), np.concatenate([y for _, y in found]))
                    yield pd.DataFrame({"a": a.view(np.int64), "b": b.view(np.int64)})
    return run


def fingerprint_links(distinct: DataFrame, bits: int = MAX_BITS) -> DataFrame:
    """Edges (a, b) whose components are those of all links at `bits` (3 or fewer) differing bits among the fingerprints (fp)."""
    if bits > 3:
        raise ValueError("two halves with one differing bit each cover three bits at most")
    placed = distinct.select("fp").mapInPandas(releasing(_replicas), "anchor bigint, away tinyint, fp bigint")
    dealt = placed.repartition("anchor").sortWithinPartitions("anchor", "away")
    return dealt.mapInPandas(releasing(_compare(bits)), "a bigint, b bigint").distinct()


def near_duplicates(docs: DataFrame, words: int = SHINGLE_WORDS, bits: int = MAX_BITS, id_col: str = "doc_id") -> DataFrame:
    """(doc_id, text_hash, fp, root, component_id): one row per row of `docs`; component_id is the smallest doc_id that links reach."""
    fps = cut_lineage(fingerprints(docs, words, id_col), "fingerprints")
    distinct = cut_lineage(fps.groupBy("fp").agg(F.min("doc_id").alias("least_id")), "fingerprint-classes")
    roots = connected_components(fingerprint_links(distinct, bits))
    classed = distinct.join(roots, distinct["fp"] == roots["node"], "left").select("fp", "least_id", F.coalesce("root", "fp").alias("root"))
    classed = cut_lineage(classed, "fingerprint-roots")
    least = cut_lineage(classed.groupBy("root").agg(F.min("least_id").alias("component_id")), "component-ids")
    named = cut_lineage(classed.join(least, "root").select("fp", "root", "component_id"), "fingerprint-components")
    return fps.join(named, "fp").select("doc_id", "text_hash", "fp", "root", "component_id")


def keep_one_each(docs: DataFrame, words: int = SHINGLE_WORDS, bits: int = MAX_BITS) -> DataFrame:
    """`docs` (with doc_id) with one row left of each component: the smallest id, of equal ids the smallest text hash, of equal rows one."""
    found = near_duplicates(docs, words, bits)
    row = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash")
    kept = found.groupBy("root", "doc_id", "text_hash").agg(F.count(F.lit(1)).alias("n")).groupBy("root").agg(F.min(F.struct(row.alias("r"), "n")).alias("k"))
    kept = cut_lineage(kept.select(F.col("k.r.doc_id").alias("__id"), F.col("k.r.text_hash").alias("__hash"), F.col("k.n").alias("__n")), "kept-ids")
    hashed = docs.withColumn("__text_hash", F.xxhash64("text"))
    left = hashed.join(kept, F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("__text_hash") == F.col("__hash")), "left_semi")
    if not kept.where("__n > 1").isEmpty():
        left = left.dropDuplicates(["doc_id", "__text_hash"])
    return left.drop("__text_hash")


def as_hex(fp):
    """16 lowercase hexadecimal digits."""
    return F.lower(F.lpad(F.hex(fp), 16, "0"))
