"""Suffix-array dedup over all documents: bytes covered by a 50-byte string that also starts in a document with a smaller id go.

The suffix array is dealt out by content. Every 50-byte window is keyed by the smallest hash among its 27 grams of 24 bytes; equal windows
have equal keys wherever they stand, and a key lasts for a run of windows, a segment. Documents are packed into chunks; then

1. each chunk asks, for its keys, whether other chunks have them too, and for its texts, which smallest id has the same text;
2. segments whose key stands in several texts go, once per chunk and content and with the smallest id that has it there, to the bucket of
   their key. A hot key (more than HOT_WINDOWS windows over all chunks) is split: its segments fall into single windows, keyed by a hash of
   the whole window, so that equal windows still meet and others are spread over all buckets. In a bucket all windows are put in suffix
   order by deep-shallow sorting (deepsort.py), and each is told whether a smaller id has it;
3. each chunk marks its windows by the answers and cuts its texts.

Keys only choose where windows are compared; the sort compares bytes. Equal texts are one text with the smallest id of their group (equal
by a 128-bit hash); copies behind it are removed whole. What leaves a chunk for a bucket is at most one entry per key, per content of a
segment, or per content of a window under a hot key. So a passage that a third of all documents share weighs as much as the number of
chunks; a line shorter than a window that they share has other neighbours, hence other windows, in each, and these are spread. The number
of buckets grows with the corpus: BUCKET_BYTES of text for each. Answers are bits in the order of the questions. No document is cut, no
pair is made.

Nulls and odd input: a null text counts as empty; a null id is larger than any other; rows with the same id are one document to each
other (they remove nothing from each other) but each row is cut by itself; texts below 50 bytes stay; an empty table gives an empty
result; other columns, of any name, are carried along.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F, types as T

from ..session import cut_lineage
from .batches import each_row, give_back, releasing, slices
from .deepsort import WORD, deep_shallow_sort

MATCH = 50
GRAM = 24
CHUNK_BYTES = 8 << 20
BUCKET_BYTES = 4 << 20
SLICE = 1 << 18
RUN = 32  # windows of a segment at most
HOT_WINDOWS = 1 << 19  # windows of a key, over all chunks, beyond which it is split
FEW_WINDOWS = 2 * RUN  # windows of a key in a chunk that are not told, but counted as so many
SEGMENTS_AT_ONCE = 1 << 15
COMPARED_AT_ONCE = 1 << 13
NO_ID = np.iinfo(np.int64).max

CHUNK_SCHEMA = "chunk bigint, rest binary, owner binary, ids binary, lengths binary, digests binary, data binary"
ASK_SCHEMA = "bucket bigint, chunk bigint, keys binary, many binary, digests binary, least binary"
ANSWER_SCHEMA = "chunk bigint, bucket bigint, shared binary, hot binary, least binary"
SEGMENT_SCHEMA = "bucket bigint, chunk bigint, lengths binary, least binary, data binary"
MARK_SCHEMA = "chunk bigint, bucket bigint, smaller binary"
CORE = ["chunk", "owner", "ids", "lengths", "digests", "data"]

_BYTE = np.random.default_rng(50).integers(0, 1 << 64, 256, dtype=np.uint64)
_STEP = [np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53), np.uint64(0xD6E8FEB86659FD93)]


def window_keys(data: np.ndarray) -> np.ndarray:
    """The key of each window of MATCH bytes: the smallest hash of its grams of GRAM = 24 bytes."""
    n = len(data) - MATCH + 1
    out = np.empty(max(n, 0), np.uint64)
    for begin in range(0, n, SLICE):
        h = _BYTE[data[begin:begin + SLICE + MATCH - 1]]
        for i, width in enumerate((1, 2, 4, 8)):
            nxt = h[:-width] * _STEP[i]
            nxt += h[width:]
            if width == 4:
                eight = nxt
            h = nxt
        g = h[:-8] * _STEP[4]
        g += eight[16:]
        g ^= g >> np.uint64(29)
        g *= _STEP[0]
        g ^= g >> np.uint64(32)
        for width in (1, 2, 4, 8):
            g = np.minimum(g[:-width], g[width:])
        rest = MATCH - GRAM + 1 - 16
        out[begin:begin + SLICE] = np.minimum(g[:-rest], g[rest:])
    return out


class Chunk:
    """The distinct texts of a chunk and their segments: (start, count, key) for each run of windows with one key."""

    def __init__(self, row):
        self.chunk = row["chunk"]
        self.owner = np.frombuffer(row["owner"], np.int32)
        self.ids = np.frombuffer(row["ids"], np.int64)
        self.lengths = np.frombuffer(row["lengths"], np.int64)
        self.digests = np.frombuffer(row["digests"], np.uint64).reshape(-1, 2)
        self.data = np.frombuffer(zstandard.decompress(row["data"], max_output_size=int(self.lengths.sum()) + 64), np.uint8)
        self.begins = np.cumsum(self.lengths) - self.lengths
        self.least = np.full(len(self.lengths), NO_ID)
        np.minimum.at(self.least, self.owner, self.ids)

    def segments(self) -> None:
        keys = window_keys(self.data[:int(self.lengths.sum())])
        cut = np.zeros(len(keys) + 1, bool)
        cut[:1] = True
        cut[1:-1] = keys[1:] != keys[:-1]
        windows = np.maximum(self.lengths - MATCH + 1, 0)
        valid_end = self.begins + windows
        edges = np.r_[self.begins, valid_end]
        cut[edges[edges < len(keys)]] = True
        starts = np.flatnonzero(cut[:-1]) if len(keys) else np.empty(0, np.int64)
        ends = np.r_[starts[1:], len(keys)] if len(starts) else starts
        text = np.searchsorted(self.begins + self.lengths, starts, "right")
        inside = (starts < valid_end[text]) if len(starts) else np.empty(0, bool)
        starts, ends, text = starts[inside], ends[inside], text[inside]
        pieces = (ends - starts + RUN - 1) // RUN
        if len(pieces) and pieces.max() > 1:
            nth = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
            starts, ends, text = np.repeat(starts, pieces) + nth * RUN, np.repeat(ends, pieces), np.repeat(text, pieces)
            ends = np.minimum(ends, starts + RUN)
        self.starts, self.counts, self.text, self.keys = starts, ends - starts, text, keys[starts] if len(starts) else np.empty(0, np.uint64)

    def asked(self, buckets: int):
        """(bucket, rest of the key) of each distinct key in order, segment -> key, whether several texts here have it, and its windows."""
        distinct, which = np.unique(self.keys, return_inverse=True)
        low, high = np.full(len(distinct), len(self.lengths)), np.full(len(distinct), -1)
        np.minimum.at(low, which, self.text)
        np.maximum.at(high, which, self.text)
        bucket = (distinct % np.uint64(buckets)).astype(np.int64)
        short = (distinct // np.uint64(buckets)) & np.uint64((1 << 40) - 1)
        order = np.lexsort((short, bucket))
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        windows = np.bincount(which, self.counts, len(distinct)).astype(np.int64)
        return bucket[order], short[order], place[which], (low != high)[order], windows[order]


def _slices(bucket: np.ndarray):
    starts = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]]) if len(bucket) else np.empty(0, np.int64)
    return zip(bucket[starts].tolist(), starts.tolist(), np.r_[starts[1:], len(bucket)].astype(np.int64).tolist())


def _rows_to_batch(rows: list[dict], schema: pa.Schema):
    return pa.RecordBatch.from_pylist(rows, schema=schema)


def _arrow(schema: str) -> pa.Schema:
    kinds = {"bigint": pa.int64(), "binary": pa.binary()}
    return pa.schema([(n, kinds[k]) for n, k in (f.strip().split() for f in schema.split(","))])


def pack(docs: DataFrame, id_col: str, text_col: str, chunk_bytes: int) -> DataFrame:
    """One row per chunk of about `chunk_bytes` of text: its distinct texts, and all rows with their other columns."""
    others = [F.col(f"`{c}`") for c in docs.columns if c != text_col]
    row_of = F.struct(*others or [F.lit(0).alias("__none")]).alias("__row")
    columns = [F.col(text_col).cast("binary").alias("__text"), F.col(id_col).cast("bigint").alias("__id"), row_of]
    schema = _arrow(CHUNK_SCHEMA)

    def row(number, texts, ids, rest):
        first: dict[bytes, int] = {}
        owner, digests, kept = np.empty(len(texts), np.int32), [], []
        for i, t in enumerate(texts):
            d = hashlib.blake2b(t, digest_size=16).digest()
            owner[i] = first.setdefault(d, len(first))
            if owner[i] == len(kept):
                kept.append(t)
                digests.append(d)
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, rest[0].schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
            for piece in rest:
                out.write_batch(piece)
        lengths = np.array([len(t) for t in kept], np.int64)
        task = TaskContext.get()
        return {"chunk": ((task.partitionId() if task else 0) << 32) + number, "rest": sink.getvalue().to_pybytes(), "owner": owner.tobytes(),
                "ids": np.array([NO_ID if i is None else i for i in ids], np.int64).tobytes(), "lengths": lengths.tobytes(), "digests": b"".join(digests),
                "data": zstandard.compress(b"".join(kept) + bytes(64), 1)}

    def run(batches):
        number, texts, ids, rest, size = 0, [], [], [], 0
        for batch in slices(batches):
            begin = 0
            found = [t or b"" for t in batch.column(0).to_pylist()]
            names = batch.column(1).to_pylist()
            for i, t in enumerate(found):
                size += len(t)
                if size >= chunk_bytes:
                    texts += found[begin:i + 1]
                    ids += names[begin:i + 1]
                    rest.append(batch.slice(begin, i + 1 - begin).select([2]))
                    yield _rows_to_batch([row(number, texts, ids, rest)], schema)
                    number, texts, ids, rest, size, begin = number + 1, [], [], [], 0, i + 1
            if begin < len(found):
                texts += found[begin:]
                ids += names[begin:]
                rest.append(batch.slice(begin).select([2]))
        if texts:
            yield _rows_to_batch([row(number, texts, ids, rest)], schema)

    return docs.select(*columns).mapInArrow(releasing(run), CHUNK_SCHEMA)


def _ask(buckets: int):
    schema = _arrow(ASK_SCHEMA)

    def run(batches):
        for row in each_row(batches):
            c = Chunk(row)
            c.segments()
            bucket, short, _, _, windows = c.asked(buckets)
            asks = {b: {"bucket": b, "chunk": c.chunk, "keys": _pack40(short[i:j]), "many": _many(windows[i:j]), "digests": b"", "least": b""}
                    for b, i, j in _slices(bucket)}
            of = (c.digests[:, 0] % np.uint64(buckets)).astype(np.int64)
            order = np.argsort(of, kind="stable")
            for b, i, j in _slices(of[order]):
                ask = asks.setdefault(b, {"bucket": b, "chunk": c.chunk, "keys": b"", "many": b""})
                ask |= {"digests": c.digests[order[i:j]].tobytes(), "least": c.least[order[i:j]].tobytes()}
            yield _rows_to_batch(list(asks.values()), schema)
    return run


def _pack40(keys: np.ndarray) -> bytes:
    """Five bytes for each key, least significant first."""
    return np.ascontiguousarray(keys.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :5]).tobytes()


def _unpack40(data: bytes) -> np.ndarray:
    short = np.frombuffer(data, np.uint8).reshape(-1, 5)
    out = np.zeros((len(short), 8), np.uint8)
    out[:, :5] = short
    return out.view("<u8").ravel()


def _many(windows: np.ndarray) -> bytes:
    """(place, windows) of the keys with more than FEW_WINDOWS windows in a chunk."""
    place = np.flatnonzero(windows > FEW_WINDOWS)
    return np.c_[place, windows[place]].astype("<u4").tobytes()


def _bits(flags: np.ndarray) -> bytes:
    return np.packbits(flags).tobytes()


def _unbits(data: bytes, n: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(data, np.uint8), count=n).astype(bool)


def _offsets(sizes) -> np.ndarray:
    return np.r_[0, np.cumsum(np.asarray(sizes, np.int64))]


def _answer(group: pa.Table, hot_windows: int) -> pa.Table:
    """For one bucket: which keys several chunks have, which of them are hot, and the smallest id of each text."""
    group = group.sort_by("chunk")
    rows = group.to_pylist()
    keys = [_unpack40(r["keys"]) for r in rows]
    at = _offsets([len(k) for k in keys])
    every = np.concatenate(keys)
    order = np.argsort(every)
    ordered = every[order]
    same = ordered[1:] == ordered[:-1]
    shared = np.empty(len(every), bool)
    shared[order] = np.r_[same, False] | np.r_[False, same] if len(every) else shared
    hot = np.zeros(len(every), bool)
    if len(every):
        windows = np.full(len(every), FEW_WINDOWS, np.int64)
        for i, r in enumerate(rows):
            many = np.frombuffer(r["many"], "<u4").reshape(-1, 2).astype(np.int64)
            windows[at[i] + many[:, 0]] = many[:, 1]
        starts = np.flatnonzero(np.r_[True, ~same])
        hot[order] = np.repeat(np.add.reduceat(windows[order], starts) > hot_windows, np.diff(np.r_[starts, len(order)]))
    digests = np.concatenate([np.frombuffer(r["digests"], np.uint64).reshape(-1, 2) for r in rows])
    least = np.concatenate([np.frombuffer(r["least"], np.int64) for r in rows])
    texts = _offsets([len(r["least"]) // 8 for r in rows])
    if len(least):
        order = np.lexsort((digests[:, 1], digests[:, 0]))
        ordered = digests[order]
        starts = np.flatnonzero(np.r_[True, (ordered[1:] != ordered[:-1]).any(axis=1)])
        lowest = np.empty(len(least), np.int64)
        lowest[order] = np.repeat(np.minimum.reduceat(least[order], starts), np.diff(np.r_[starts, len(order)]))
        least = lowest
    out = [{"chunk": r["chunk"], "bucket": r["bucket"], "shared": _bits(shared[at[i]:at[i + 1]]),
            "hot": _bits(hot[at[i]:at[i + 1]]) if hot[at[i]:at[i + 1]].any() else b"", "least": least[texts[i]:texts[i + 1]].tobytes()}
           for i, r in enumerate(rows)]
    return pa.Table.from_pylist(out, schema=_arrow(ANSWER_SCHEMA))


def _candidates(c: Chunk, answers: list[dict], buckets: int):
    """Segments of the texts this chunk answers for whose key stands in several texts: their numbers, and the texts' smallest ids.

    Segments of hot keys are split into their windows, each with a key of its own.
    """
    c.segments()
    bucket, _, place, several, _ = c.asked(buckets)
    flagged, least, hot = several.copy(), c.least.copy(), np.zeros(len(several), bool)
    of = (c.digests[:, 0] % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(of, kind="stable")
    by_bucket = {a["bucket"]: a for a in answers}
    for b, i, j in _slices(bucket):
        flagged[i:j] |= _unbits(by_bucket[b]["shared"], j - i)
        if by_bucket[b]["hot"]:
            hot[i:j] = _unbits(by_bucket[b]["hot"], j - i)
    for b, i, j in _slices(of[order]):
        least[order[i:j]] = np.frombuffer(by_bucket[b]["least"], np.int64)
    mine = c.least == least  # a copy of a text with a smaller id elsewhere goes whole
    chosen = np.flatnonzero(flagged[place] & mine[c.text])
    if hot.any():
        chosen = _split(c, chosen, hot[place])
    return chosen, least


def _split(c: Chunk, chosen: np.ndarray, hot: np.ndarray) -> np.ndarray:
    """Makes the chosen segments the chunk's only ones, those that are hot window by window under a hash of the window; their new numbers."""
    n = np.where(hot[chosen], c.counts[chosen], 1)
    rows, nth = np.repeat(chosen, n), np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
    single = hot[rows]
    c.starts, c.text, c.counts, c.keys = c.starts[rows] + nth, c.text[rows], np.where(single, 1, c.counts[rows]), c.keys[rows]
    c.keys[single] = _hashes(c.data, c.starts[single], np.full(int(single.sum()), MATCH))
    return np.arange(len(rows))


def _hashes(data: np.ndarray, starts: np.ndarray, size: np.ndarray) -> np.ndarray:
    """A hash of the `size` bytes at each start."""
    hashes = size.astype(np.uint64)
    view = np.ndarray((len(data) - WORD + 1,), dtype="<u8", buffer=data, strides=(1,))
    for d in range(0, int(size.max()) if len(size) else 0, WORD):
        word = view[np.minimum(starts + d, len(view) - 1)]
        left = np.clip(size - d, 0, WORD)
        keep = np.where(left >= WORD, np.uint64(0xFFFFFFFFFFFFFFFF), (np.uint64(1) << (left % WORD * 8).astype(np.uint64)) - np.uint64(1))
        hashes = (hashes ^ (word & keep)) * _STEP[0]
        hashes ^= hashes >> np.uint64(32)
    return hashes


def _contents(c: Chunk, chosen: np.ndarray):
    """Chosen segments with equal bytes as one: (row of each content in `chosen`, content of each segment, smallest id per content)."""
    width = -(-(RUN + MATCH - 1) // WORD) * WORD
    size = c.counts[chosen] + MATCH - 1
    first, which = np.empty(0, np.int64), np.empty(len(chosen), np.int64)
    if len(chosen):
        data = np.concatenate([c.data, np.zeros(width, np.uint8)]) if len(c.data) < c.starts[chosen[-1]] + width else c.data
        hashes = _hashes(data, c.starts[chosen], size) ^ c.keys[chosen]
        _, first, which = np.unique(hashes, return_index=True, return_inverse=True)
        # equal by two hashes; the bytes decide: what differs from its representative stays apart
        twin = first[which]
        odd = size != size[twin]
        span = np.arange(RUN + MATCH - 1)
        for i in range(0, len(chosen), COMPARED_AT_ONCE):
            rows = slice(i, i + COMPARED_AT_ONCE)
            a = data[np.minimum(c.starts[chosen[rows], None] + span, len(data) - 1)]
            b = data[np.minimum(c.starts[chosen[twin[rows]], None] + span, len(data) - 1)]
            odd[rows] |= ((a != b) & (span < size[rows, None])).any(axis=1)
        if odd.any():
            which[odd] = len(first) + np.arange(odd.sum())
            first = np.r_[first, np.flatnonzero(odd)]
    low = np.full(len(first), NO_ID)
    np.minimum.at(low, which, c.least[c.text[chosen]])
    return first, which, low


def _content_order(c: Chunk, chosen: np.ndarray, first: np.ndarray, buckets: int):
    bucket = (c.keys[chosen[first]] % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    return bucket[order], order


def _send(buckets: int):
    schema = _arrow(SEGMENT_SCHEMA)

    def run(batches):
        for row in each_row(batches):
            c = Chunk(row)
            chosen, _ = _candidates(c, row["answers"], buckets)
            first, _, low = _contents(c, chosen)
            bucket, order = _content_order(c, chosen, first, buckets)
            rows = []
            for b, i, j in _slices(bucket):
                some = chosen[first[order[i:j]]]
                begin, size = c.starts[some], c.counts[some] + MATCH - 1
                at = np.repeat(begin - (np.cumsum(size) - size), size) + np.arange(size.sum())
                rows.append({"bucket": b, "chunk": c.chunk, "lengths": c.counts[some].astype(np.uint8).tobytes(), "least": low[order[i:j]].tobytes(),
                             "data": c.data[at].tobytes()})
            yield _rows_to_batch(rows, schema)
    return run


def smaller_elsewhere(data: np.ndarray, counts: np.ndarray, least: np.ndarray) -> np.ndarray:
    """For every window of segments laid end to end: whether a segment with a smaller id has the same bytes."""
    sizes = counts + MATCH - 1
    begins = np.cumsum(sizes) - sizes
    total = int(counts.sum())
    at = np.repeat(begins - (np.cumsum(counts) - counts), counts) + np.arange(total)
    owner = np.repeat(least, counts)
    order, group = deep_shallow_sort(np.concatenate([data, np.zeros(WORD, np.uint8)]), at, MATCH)
    if not total:
        return np.empty(0, bool)
    starts = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
    lowest = np.minimum.reduceat(owner[order], starts)[group]
    out = np.empty(total, bool)
    out[order] = lowest < owner[order]
    return out


def _mark(group: pa.Table) -> pa.Table:
    group = group.sort_by("chunk")
    rows = group.to_pylist()
    counts = [np.frombuffer(r["lengths"], np.uint8).astype(np.int64) for r in rows]
    at = _offsets([c.sum() for c in counts])
    found = smaller_elsewhere(np.frombuffer(b"".join(r["data"] for r in rows), np.uint8), np.concatenate(counts),
                              np.concatenate([np.frombuffer(r["least"], np.int64) for r in rows]))
    out = [{"chunk": r["chunk"], "bucket": r["bucket"], "smaller": _bits(found[at[i]:at[i + 1]])} for i, r in enumerate(rows)]
    return pa.Table.from_pylist(out, schema=_arrow(MARK_SCHEMA))


def removed_spans(starts: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, begin, end) of the maximal runs of bytes under windows that begin at the sorted `starts`, text by text."""
    if not len(starts):
        return text, starts, starts
    cut = np.flatnonzero((np.diff(starts) > MATCH) | (text[1:] != text[:-1]))
    first, last = np.r_[0, cut + 1], np.r_[cut, len(starts) - 1]
    return text[first], starts[first], starts[last] + MATCH


def joined_spans(parts: list[tuple]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The spans of consecutive parts of the windows, those that touch across parts as one."""
    if not parts:
        return (np.empty(0, np.int64),) * 3
    text, begin, end = (np.concatenate(x) for x in zip(*parts))
    if not len(text):
        return text, begin, end
    new = np.r_[True, (begin[1:] > end[:-1]) | (text[1:] != text[:-1])]
    return text[new], begin[new], end[np.r_[np.flatnonzero(new)[1:] - 1, len(end) - 1]]


def _marked(group: pa.Table) -> pa.Table:
    """_mark, with the bucket's memory given back before the next one comes."""
    out = _mark(group)
    give_back()
    return out


def _cut(buckets: int, schema: pa.Schema, text_col: str, columns: list[str], with_text: bool):
    def texts(c, row):
        """Spans (relative to the text) of each distinct text for its smallest id; whole copies are dealt with by row."""
        chosen, least = _candidates(c, row["answers"], buckets)
        first, which, low = _contents(c, chosen)
        bucket, order = _content_order(c, chosen, first, buckets)
        marks = {m["bucket"]: m["smaller"] for m in row["marks"] or []}
        counts = c.counts[chosen[first[order]]] if len(first) else np.empty(0, np.int64)
        at = _offsets(counts)
        flags = np.empty(int(at[-1]), bool)
        for b, i, j in _slices(bucket):
            flags[at[i]:at[j]] = _unbits(marks[b], int(at[j] - at[i]))
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        found = []
        for i in range(0, len(chosen), SEGMENTS_AT_ONCE):
            rows = slice(i, i + SEGMENTS_AT_ONCE)
            n, text = c.counts[chosen[rows]], c.text[chosen[rows]]
            spread = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
            behind = c.least[text] > low[which[rows]]
            gone = flags[np.repeat(at[:-1][place[which[rows]]], n) + spread] | np.repeat(behind, n)
            found.append(removed_spans((np.repeat(c.starts[chosen[rows]], n) + spread)[gone], np.repeat(text, n)[gone]))
        owner, begin, end = joined_spans(found)
        spans = [None] * len(c.lengths)
        edges = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]]) if len(owner) else np.empty(0, np.int64)
        for i, j in zip(edges, np.r_[edges[1:], len(owner)].astype(np.int64)):
            t = owner[i]
            spans[t] = ((begin[i:j] - c.begins[t]).tolist(), (end[i:j] - c.begins[t]).tolist())
        return spans, least

    def run(batches):
        for row in each_row(batches):
            c = Chunk(row)
            spans, least = texts(c, row)
            whole = c.data.tobytes()
            found: dict[str, list] = {k: [] for k in ("n_bytes", "n_removed", "spans", "kept_sha256", "kept")}
            done: dict[tuple, tuple] = {}
            for t, i in zip(c.owner.tolist(), c.ids.tolist()):
                copy = i > least[t]
                if (t, copy) not in done:
                    n = int(c.lengths[t])
                    text = whole[c.begins[t]:c.begins[t] + n]
                    pairs = ([(0, n)] if n >= MATCH else []) if copy else list(zip(*spans[t])) if spans[t] else []
                    kept, last = [], 0
                    for a, b in pairs:
                        kept.append(text[last:a])
                        last = b
                    left = b"".join(kept) + text[last:] if pairs else text
                    done[t, copy] = (n, sum(b - a for a, b in pairs), [{"begin": a, "end": b} for a, b in pairs], hashlib.sha256(left).hexdigest(),
                                     left.decode("utf-8", "ignore") if with_text else None)
                for k, v in zip(found, done[t, copy]):
                    found[k].append(v)
            rest = pa.ipc.open_stream(row["rest"]).read_all().combine_chunks()
            others = rest.column(0).combine_chunks()
            others = others.flatten() if not isinstance(others, pa.ChunkedArray) else others.chunk(0).flatten()
            named = dict(zip([f.name for f in rest.schema.field(0).type], others))
            arrays = []
            for f in schema:
                if f.name in found_names:
                    arrays.append(pa.array(found[found_names[f.name]], f.type))
                else:
                    arrays.append(named[f.name].cast(f.type))
            yield pa.RecordBatch.from_arrays(arrays, schema=schema)

    found_names = {"__n_bytes": "n_bytes", "__n_removed": "n_removed", "__spans": "spans", "__kept_sha256": "kept_sha256", "__kept": "kept"}
    return run


def answered(chunks: DataFrame, buckets: int, hot_windows: int = HOT_WINDOWS) -> DataFrame:
    """(chunk, answers): what each chunk is told about its keys and texts, bucket by bucket."""
    asked = chunks.select(*CORE).mapInArrow(releasing(_ask(buckets)), ASK_SCHEMA)
    answers = asked.groupBy("bucket").applyInArrow(lambda group: _answer(group, hot_windows), ANSWER_SCHEMA)
    return answers.groupBy("chunk").agg(F.collect_list(F.struct("bucket", "shared", "hot", "least")).alias("answers"))


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", with_text: bool = True, chunk_bytes: int = CHUNK_BYTES,
                   bucket_bytes: int = BUCKET_BYTES, hot_windows: int = HOT_WINDOWS) -> DataFrame:
    """Every row of `docs` with its columns but the text, and __n_bytes, __n_removed, __spans (begin, end in bytes), __kept_sha256 of the
    kept bytes, and __kept: the kept text, without bytes that are no longer whole characters (null unless `with_text`)."""
    from pyspark.sql.pandas.types import to_arrow_schema

    chunks = cut_lineage(pack(docs, id_col, text_col, chunk_bytes), "suffix-chunks")
    total = chunks.agg(F.sum(F.expr("length(data)")).alias("b"), F.count(F.lit(1)).alias("n")).first()
    buckets = max(1, -(-3 * (total["b"] or 0) // bucket_bytes))  # text is about three times its compressed size
    answers = cut_lineage(answered(chunks, buckets, hot_windows), "suffix-answers")
    sent = chunks.select(*CORE).join(answers, "chunk").mapInArrow(releasing(_send(buckets)), SEGMENT_SCHEMA)
    marks = sent.groupBy("bucket").applyInArrow(_marked, MARK_SCHEMA)
    marks = cut_lineage(marks.groupBy("chunk").agg(F.collect_list(F.struct("bucket", "smaller")).alias("marks")), "suffix-marks")
    own = [f for f in docs.schema.fields if f.name != text_col]
    schema = T.StructType([*own, T.StructField("__n_bytes", T.LongType()), T.StructField("__n_removed", T.LongType()),
                           T.StructField("__spans", T.ArrayType(T.StructType([T.StructField("begin", T.LongType()), T.StructField("end", T.LongType())]))),
                           T.StructField("__kept_sha256", T.StringType()), T.StructField("__kept", T.StringType())])
    whole = chunks.join(answers, "chunk").join(marks, "chunk", "left")
    cut = _cut(buckets, to_arrow_schema(schema), text_col, docs.columns, with_text)
    return whole.mapInArrow(releasing(cut), schema)


def keep_first_occurrences(docs: DataFrame) -> DataFrame:
    """`docs` (doc_id, text and any other columns) with repeated bytes cut from the texts; n_chars, where there is one, is that of the new text."""
    cut = remove_repeats(docs)
    values = {"text": F.col("__kept")}
    if "n_chars" in docs.columns:
        values["n_chars"] = F.length("__kept").cast(docs.schema["n_chars"].dataType)
    return cut.select(*[values.get(c, F.col(f"`{c}`")).alias(c) for c in docs.columns])
