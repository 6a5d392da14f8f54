"""Spelling variants by PartEnum signatures.

Words at one inserted, deleted or replaced letter from each other have letter multisets that differ in at most two places. A multiset is
a binary vector: place (letter, k) is set if the letter occurs more than k times. Partition and enumerate: the places are dealt to
`PARTS` parts, and a word has one signature for every way to leave `LEFT_OUT` parts out, a hash of what it has in the others. Two vectors
at Hamming distance two or less differ in two parts at most, so some signature of theirs is equal. Words are equi-joined by signature and
verified: lengths, a 64-bit sketch of the vector, then the letters themselves. A pair is taken at one signature only, the first that
leaves out the parts in which it differs; these follow from the letters that were changed.

The parts are balanced by how often each place is set in all words (`PLACES` of them are counted, the rest is dealt by hash).

Large groups: words of one signature are compared among each other, up to `GROUP_WORDS`. The words of a larger group are dealt out again
by signature and one-letter deletion: every pair at distance one has a deletion in common, and a group of one deletion holds at most one
word for each letter and place, whatever the input. So comparisons per word are bounded and no pair is lost. Neither candidates nor pairs
become rows: a task adds up each word's near words and keeps the best.

Nulls and odd input: a null text has no words; a null id counts as an empty one in the checksum that deletes letters; repeated rows
count as often as they stand; ties go to the smallest word in code-point order; an empty table gives an empty result; other columns
are not read. Words of any length take part (those over `MATRIX` letters are verified one by one).
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..session import cut_lineage

PARTS = 7
LEFT_OUT = 2
PLACES = 3
GROUP_WORDS = 1024
MATRIX = 48
PAIRS_AT_ONCE = 1 << 20
ROWS_AT_ONCE = 1 << 15
MIN_LETTERS = 5
MIN_COUNT = 3
SLIPS = 97

#: Parts that a signature leaves out, by its number, and the first number that leaves out two given parts.
SKIPS = list(combinations(range(PARTS), LEFT_OUT))
FIRST_SKIP = np.array([[min(k for k, s in enumerate(SKIPS) if {a, b} <= set(s)) for b in range(PARTS)] for a in range(PARTS)])
BASE = np.uint64(0x9E3779B97F4A7C15)
BASE_INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def word_counts(docs: DataFrame, min_letters: int = MIN_LETTERS, min_count: int = MIN_COUNT, slips: int = SLIPS) -> DataFrame:
    """(word, n): runs of letters in lower case (A-Z only) after the letter deletions that the checksum of id and run asks for."""
    runs = F.regexp_extract_all(F.translate("text", UPPER, UPPER.lower()), F.lit("[a-zÀ-ÿ]+"), F.lit(0))
    rows = docs.select(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":")).alias("head"), F.explode(runs).alias("run"))
    rows = rows.select("run", F.crc32(F.concat("head", "run").cast("binary")).alias("h"), F.length("run").alias("letters"))
    place = (F.col("h") % F.col("letters")).cast("int")
    shorter = F.concat(F.col("run").substr(F.lit(1), place), F.col("run").substr(place + 2, F.col("letters")))
    words = rows.where(F.col("letters") >= min_letters).select(F.when(F.col("h") % slips == 0, shorter).otherwise(F.col("run")).alias("word"))
    return words.where(F.length("word") >= min_letters).groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_count)


def mixed(x: np.ndarray) -> np.ndarray:
    """Well-spread 64 bits for every number."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def matrix(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Letters of every word in a row (0 behind its end; rows of longer words than MATRIX are zero), and the lengths."""
    words = words.cast(pa.large_binary())
    ends = np.frombuffer(words.buffers()[1], np.int64, len(words) + 1, words.offset * 8)
    data = np.frombuffer(words.buffers()[2], np.uint8) if words.buffers()[2] is not None else np.empty(0, np.uint8)
    lengths = np.diff(ends)
    width = int(min(MATRIX, lengths.max(initial=1)))
    out = np.zeros((len(lengths), width), np.uint8)
    column = np.arange(width)
    inside = (column < lengths[:, None]) & (lengths <= width)[:, None]
    out[inside] = data[(ends[:-1, None] + column)[inside]]
    return out, lengths


def occurrences(letters: np.ndarray) -> np.ndarray:
    """How often each letter stood in its row before."""
    out = np.zeros(letters.shape, np.int64)
    for i in range(letters.shape[1]):
        out[:, i + 1:] += letters[:, i + 1:] == letters[:, i:i + 1]
    return out


class PlaceParts:
    """Part of every place (letter, k) of the binary vectors."""

    def __init__(self, table: np.ndarray):
        self.table = table

    @classmethod
    def fit(cls, words: DataFrame) -> "PlaceParts":
        """Deals the places in the order of how many words have them; the counts of 256 x PLACES places are all that comes to the driver."""
        def count(batches):
            for batch in batches:
                letters, lengths = matrix(batch.column(0))
                k = occurrences(letters)
                use = (letters > 0) & (k < PLACES)
                places, n = np.unique(letters[use].astype(np.int64) + 256 * k[use], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(places), pa.array(n.astype(np.int64))], ["place", "n"])
        sums = words.select("letters").mapInArrow(count, "place bigint, n bigint").groupBy("place").agg(F.sum("n").alias("n")).collect()
        order = [r["place"] for r in sorted(sums, key=lambda r: (-r["n"], r["place"]))]
        table = (mixed(np.arange(256 * PLACES, dtype=np.uint64)) % np.uint64(PARTS)).astype(np.int64)
        for i, place in enumerate(order):
            turn, at = divmod(i, PARTS)
            table[place] = at if turn % 2 == 0 else PARTS - 1 - at
        return cls(table)

    def of(self, letter: np.ndarray, k: np.ndarray) -> np.ndarray:
        place = letter.astype(np.int64) + 256 * k
        far = (mixed(place.astype(np.uint64)) % np.uint64(PARTS)).astype(np.int64)
        return np.where(k < PLACES, self.table[np.minimum(place, len(self.table) - 1)], far)


def signatures(words: pa.Array, parts: PlaceParts) -> tuple[np.ndarray, np.ndarray]:
    """(signatures, one column per way to leave parts out; sketches)."""
    letters, lengths = matrix(words)
    k = occurrences(letters)
    place = mixed((letters.astype(np.uint64) | (k.astype(np.uint64) << np.uint64(8))) + np.uint64(1))
    part = np.where(letters > 0, parts.of(letters, k), -1)
    by_part = np.stack([np.bitwise_xor.reduce(np.where(part == p, place, np.uint64(0)), axis=1) for p in range(PARTS)], axis=1)
    bit = np.where(letters > 0, np.uint64(1) << (place >> np.uint64(58)), np.uint64(0))
    sketch = np.bitwise_xor.reduce(bit, axis=1)
    for row in np.flatnonzero(lengths > letters.shape[1]):
        text = np.frombuffer(words[int(row)].as_py(), np.uint8)
        order = np.argsort(text, kind="stable")
        ranked = text[order]
        k = np.arange(len(ranked)) - np.searchsorted(ranked, ranked)
        place = mixed((ranked.astype(np.uint64) | (k.astype(np.uint64) << np.uint64(8))) + np.uint64(1))
        part = parts.of(ranked, k)
        by_part[row] = [np.bitwise_xor.reduce(place[part == p], initial=np.uint64(0)) for p in range(PARTS)]
        sketch[row] = np.bitwise_xor.reduce(np.uint64(1) << (place >> np.uint64(58)))
    whole = np.bitwise_xor.reduce(by_part, axis=1)
    columns = [mixed(whole ^ by_part[:, a] ^ by_part[:, b] ^ np.uint64(i)) & ~np.uint64(31) | np.uint64(i) for i, (a, b) in enumerate(SKIPS)]
    return np.stack(columns, axis=1), sketch


def deletions(word: bytes) -> np.ndarray:
    """Hashes of the word and of the word without each of its letters."""
    powers = np.cumprod(np.full(len(word), BASE, np.uint64))
    sums = np.concatenate([[np.uint64(0)], np.cumsum(np.frombuffer(word, np.uint8) * powers, dtype=np.uint64)])
    return np.unique(np.append(sums[:-1] + (sums[-1] - sums[1:]) * BASE_INVERSE, sums[-1]))


def _place(words: DataFrame, parts: PlaceParts) -> DataFrame:
    """(sig, sketch, word, n) for every signature of every word."""
    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                piece = batch.slice(at, 4096)
                sigs, sketch = signatures(piece.column(0), parts)
                again = pa.array(np.repeat(np.arange(piece.num_rows), sigs.shape[1]))
                yield pa.RecordBatch.from_arrays([pa.array(sigs.ravel().view(np.int64)), pa.array(sketch.view(np.int64)).take(again),
                                                  piece.column(0).take(again), piece.column(1).take(again)], ["sig", "sketch", "word", "n"])
    return words.select("letters", "n").mapInArrow(run, "sig bigint, sketch bigint, word binary, n bigint")


class _Compare:
    """Near words among words of one group, for many groups at once."""

    def __init__(self, parts: PlaceParts):
        self.parts = parts

    def near(self, starts, sig, sketch, words, key=None):
        """Index pairs at distance one within groups that begin at `starts`, each pair where its first common signature is (and, with
        deletion keys, at the deletion that leaves out the changed letter)."""
        letters, lengths = matrix(words)
        backwards = np.zeros_like(letters)
        column = np.arange(letters.shape[1])
        short = lengths <= letters.shape[1]
        inside = (column < lengths[:, None]) & short[:, None]
        backwards[inside] = letters[np.nonzero(inside)[0], (lengths[:, None] - 1 - column)[inside]]
        ends = np.append(starts[1:], len(lengths))
        later = np.repeat(ends, ends - starts) - np.arange(len(lengths)) - 1
        total = np.cumsum(later)
        found = []
        at = 0
        while at < len(later):
            before = total[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(total, before + PAIRS_AT_ONCE, "right")))
            n = later[at:to]
            i = np.repeat(np.arange(at, to), n)
            j = i + 1 + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            at = to
            close = (np.bitwise_count(sketch[i] ^ sketch[j]) <= 2) & (np.abs(lengths[i] - lengths[j]) <= 1) & (sig[i] == sig[j])
            i, j = i[close], j[close]
            swap = lengths[i] < lengths[j]
            i, j = np.where(swap, j, i), np.where(swap, i, j)
            plain = short[i]
            found += self._verify(letters, backwards, lengths, sig, i[plain], j[plain], key)
            found += [p for p in (self._verify_one(words, sig, int(a), int(b), key) for a, b in zip(i[~plain], j[~plain])) if p]
        if not found:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        return np.concatenate([a for a, _ in found]), np.concatenate([b for _, b in found])

    def _verify(self, letters, backwards, lengths, sig, i, j, key):
        if not len(i):
            return []
        a, b = letters[i], letters[j]
        other = a != b
        p = other.argmax(axis=1)
        same = lengths[i] == lengths[j]
        tail = (backwards[i] != backwards[j]).argmax(axis=1)
        one = np.where(same, other.sum(axis=1) == 1, p + tail >= lengths[j])
        i, j, a, b, p, same = i[one], j[one], a[one], b[one], p[one], same[one]
        rows = np.arange(len(i))
        gone, come = a[rows, p], b[rows, p]
        first = self.parts.of(gone, (a == gone[:, None]).sum(axis=1) - 1)
        second = np.where(same, self.parts.of(come, np.maximum((b == come[:, None]).sum(axis=1) - 1, 0)), first)
        take = FIRST_SKIP[first, second] == (sig[i] & np.uint64(31)).astype(np.int64)
        if key is not None and len(i):
            powers = np.cumprod(np.full(letters.shape[1], BASE, np.uint64))
            sums = np.zeros((len(i), letters.shape[1] + 1), np.uint64)
            np.cumsum(a * powers, axis=1, dtype=np.uint64, out=sums[:, 1:])
            without = sums[rows, p] + (sums[:, -1] - sums[rows, p + 1]) * BASE_INVERSE
            take &= without == key[i]
        return [(i[take], j[take])]

    def _verify_one(self, words, sig, i, j, key):
        a, b = words[i].as_py(), words[j].as_py()
        x, y = np.frombuffer(a, np.uint8), np.frombuffer(b, np.uint8)
        differ = np.flatnonzero(x[:len(y)] != y)
        p = int(differ[0]) if len(differ) else len(y)
        if a == b or a[p + 1:] != (b[p + 1:] if len(a) == len(b) else b[p:]):
            return None
        first = self.parts.of(x[p], np.int64(a.count(a[p]) - 1))
        second = self.parts.of(y[p], np.int64(b.count(b[p]) - 1)) if len(a) == len(b) else first
        if FIRST_SKIP[first, second] != int(sig[i] & np.uint64(31)):
            return None
        if key is not None:
            powers = np.cumprod(np.full(len(a), BASE, np.uint64))
            sums = np.concatenate([[np.uint64(0)], np.cumsum(x * powers, dtype=np.uint64)])
            if sums[p] + (sums[-1] - sums[p + 1]) * BASE_INVERSE != key[i]:
                return None
        return np.array([i]), np.array([j])


OUT = "sig bigint, word binary, n bigint, near bigint, best binary, best_n bigint"


def _summary(words: pa.Array, n: np.ndarray, i: np.ndarray, j: np.ndarray):
    """One row per word that has near words: their number, and the best among those at least twice as frequent."""
    left, right = np.concatenate([i, j]), np.concatenate([j, i])
    near = np.bincount(left, minlength=len(n))
    best = np.full(len(n), -1)
    strong = n[right] >= 2 * n[left]
    left, right = left[strong], right[strong]
    if len(left):
        used, place = np.unique(right, return_inverse=True)
        names = words.take(pa.array(used)).to_pylist()
        rank = np.empty(len(used), np.int64)
        rank[sorted(range(len(used)), key=names.__getitem__)] = np.arange(len(used))
        order = np.lexsort((rank[place], -n[right], left))
        first = np.flatnonzero(np.r_[True, left[order][1:] != left[order][:-1]])
        best[left[order][first]] = right[order][first]
    rows = np.flatnonzero(near)
    none = best[rows] < 0
    at = pa.array(np.where(none, 0, best[rows]), mask=none)
    nothing = pa.nulls(len(rows), pa.int64())
    return pa.RecordBatch.from_arrays([nothing, words.take(pa.array(rows)), pa.array(n[rows]), pa.array(near[rows].astype(np.int64)),
                                       words.take(at), pa.array(n).take(at)], OUT.replace(" bigint", "").replace(" binary", "").split(", "))


def _groups(batches, key: str, limit: int | None):
    """Whole groups of rows with equal keys, about ROWS_AT_ONCE rows at a time: (table, group starts). The rows of a group above `limit` come
    apart, as (table, None), as soon as it is found to be larger."""
    held, large = [], None

    def out(table, keys):
        starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
        sizes = np.diff(np.append(starts, len(keys)))
        if limit and (sizes > limit).any():
            big = np.repeat(sizes > limit, sizes)
            yield table.filter(pa.array(big)), None
            table, keys = table.filter(pa.array(~big)), keys[~big]
            starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.empty(0, np.int64)
        if len(starts):
            yield table, starts

    for batch in batches:
        for at in range(0, batch.num_rows, ROWS_AT_ONCE):
            table = pa.Table.from_batches([batch.slice(at, ROWS_AT_ONCE)])
            keys = table[key].to_numpy()
            if large is not None:
                go_on = int(np.searchsorted(keys != large, True)) if (keys != large).any() else len(keys)
                if go_on:
                    yield table.slice(0, go_on), None
                if go_on == len(keys):
                    continue
                large, table = None, table.slice(go_on)
            held.append(table)
            whole = pa.concat_tables(held).combine_chunks()
            keys = whole[key].to_numpy()
            if len(keys) < ROWS_AT_ONCE:
                held = [whole]
                continue
            cut = int(np.searchsorted(keys == keys[-1], True))  # keys are sorted: the last group may go on
            if cut:
                yield from out(whole.slice(0, cut), keys[:cut])
            held = [whole.slice(cut)]
            if limit and len(keys) - cut > limit:
                yield held[0], None
                held, large = [], keys[-1]
    if held:
        whole = pa.concat_tables(held).combine_chunks()
        if whole.num_rows:
            yield from out(whole, whole[key].to_numpy())


def _compared(parts: PlaceParts, key: str, limit: int | None):
    def run(batches):
        compare = _Compare(parts)
        for table, starts in _groups(batches, key, limit):
            if starts is None:
                nothing = pa.nulls(table.num_rows, pa.int64())
                blank = pa.nulls(table.num_rows, pa.binary())
                yield from pa.table([table["sig"], table["word"], table["n"], nothing, blank, nothing],
                                    names=["sig", "word", "n", "near", "best", "best_n"]).to_batches()
                continue
            words = table["word"].combine_chunks()
            words = words.chunk(0) if isinstance(words, pa.ChunkedArray) else words
            unsigned = lambda c: table[c].to_numpy().view(np.uint64)
            i, j = compare.near(starts, unsigned("sig"), unsigned("sketch"), words, unsigned("deletion") if "deletion" in table.column_names else None)
            if len(i):
                yield _summary(words, table["n"].to_numpy(), i, j)
    return run


def _by_deletion(parts: PlaceParts):
    """(key, deletion, sig, sketch, word, n) for the word and each of its one-letter deletions."""
    names = ["key", "deletion", "sig", "sketch", "word", "n"]

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                piece = batch.slice(at, 512)
                sig = piece.column(0).to_numpy().view(np.uint64)
                _, sketch = signatures(piece.column(1), parts)
                gone = [deletions(w) for w in piece.column(1).to_pylist()]
                again = np.repeat(np.arange(len(gone)), [len(g) for g in gone])
                hashes = np.concatenate(gone)
                key = mixed(hashes ^ mixed(sig[again]))
                taken = pa.array(again)
                yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(hashes.view(np.int64)), piece.column(0).take(taken),
                                                  pa.array(sketch.view(np.int64)).take(taken), piece.column(1).take(taken), piece.column(2).take(taken)], names)
    return run


def near_words(words: DataFrame, group_words: int = GROUP_WORDS) -> DataFrame:
    """(word, n_near, form, form_n) for words (word, n) that have near words. `words` has distinct words of letters up to U+00FF."""
    coded = words.select(F.encode("word", "ISO-8859-1").alias("letters"), "n")
    parts = PlaceParts.fit(coded)
    dealt = _place(coded, parts).repartition("sig").sortWithinPartitions("sig")
    first = cut_lineage(dealt.mapInArrow(_compared(parts, "sig", group_words), OUT), "spelling-signatures")
    again = first.where("sig is not null").select("sig", "word", "n").mapInArrow(
        _by_deletion(parts), "key bigint, deletion bigint, sig bigint, sketch bigint, word binary, n bigint")
    second = again.repartition("key").sortWithinPartitions("key").mapInArrow(_compared(parts, "key", None), OUT)
    partial = first.where("sig is null").unionByName(second)
    best = F.min(F.when(F.col("best").isNotNull(), F.struct((-F.col("best_n")).alias("n"), F.col("best").alias("word"))))
    found = partial.groupBy("word").agg(F.sum("near").alias("n_near"), best.alias("best"))
    text = lambda c: F.decode(c, "ISO-8859-1")
    return found.select(text("word").alias("word"), "n_near", text("best.word").alias("form"), (-F.col("best.n")).alias("form_n"))


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) for words with a form: the last one reached. Frequencies at least double from word to form, so chains are short; pointers
    double their reach in every step until none moves."""
    current = cut_lineage(forms.where("form is not null").select("word", F.col("form").alias("root")), "spelling-forms")
    while True:
        on = current.select(F.col("word").alias("root"), F.col("root").alias("further"))
        moved = cut_lineage(current.join(on, "root", "left").select("word", F.coalesce("further", "root").alias("root"),
                                                                    F.col("further").isNotNull().alias("moved")), "spelling-roots")
        current = moved.select("word", "root")
        if moved.where("moved").isEmpty():
            return current


def spelling_variants(docs: DataFrame, min_letters: int = MIN_LETTERS, min_count: int = MIN_COUNT, slips: int = SLIPS) -> DataFrame:
    """(word, form, root, n, n_near, form_n) for every word of the documents (doc_id, text)."""
    words = cut_lineage(word_counts(docs, min_letters, min_count, slips), "spelling-words")
    near = cut_lineage(near_words(words), "spelling-near")
    named = words.join(near, "word", "left").join(roots(near), "word", "left")
    return named.select("word", "form", F.coalesce("root", "word").alias("root"), "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), "form_n")
