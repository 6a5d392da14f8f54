"""Language identification by nearest centroids of normalised TF-IDF n-gram vectors.

A text is reduced to its letters (lower-cased, runs of anything else as one blank) and counted in hashed n-grams of one to three
characters. Term frequencies are damped by a square root, weighted by inverse document frequency and brought to length one. Each
language has several centroids: its training texts are halved at the median along the direction in which they spread most, the halves again until
there are CENTROIDS parts, and spherical k-means goes on from there as long as every cluster keeps `LEAST_CLUSTER` of the texts; so a
language with enough texts never ends with one centroid, and no single text is one. A text gets the language of the centroid with the largest cosine; the cosine is the score. A text is rejected if its distance (one
minus the cosine) from that centroid is beyond its language's limit for texts of as many n-grams, or if it has no letter. Short texts lie
further off than long ones, so each band of distinct n-grams (powers of two) has its own limit: halfway from the `REJECT_QUANTILE` of the
training texts' distances to 1, never above `REJECT_MOST`. Where a language has fewer than `BAND_TEXTS` training texts in a band, those of
all languages count, and if these are too few, the limit is that of the next shorter band, or else `REJECT_MOST`. At least the farthest
text of a band doesn't count, so no single text sets a limit.

Training reads a bounded sample: per language the `SAMPLE_PER_LANGUAGE` different rows (id, text) with a letter whose hashes are smallest; whole
texts, and document frequencies over the whole sample. There may be `LANGUAGES_MOST` languages, more are refused, as the model goes to every task. Nulls and odd input: a text that is null or has no letter is `und` with score 0; without
training rows every text is `und`; training rows need a text with a letter and a language; null ids are not trained on, and are not held
out; repeated rows are separate; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import re

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from ..session import cut_lineage
from .batches import releasing, slices

UNKNOWN = "und"
#: Bounds of the sample that the classifier is fitted on, and of its size.
SAMPLE_PER_LANGUAGE = 400
#: Rows that may reach the choice of a language's sample, in sizes of the sample.
HASH_MARGIN = 8
DIMENSIONS = 1 << 13
CENTROIDS = 3
STEPS = 6
PIECE = 1 << 18
REJECT_QUANTILE = 0.98
REJECT_MOST = 0.95
BANDS = DIMENSIONS.bit_length()
#: Fewer texts say nothing about the quantile.
BAND_TEXTS = 50
#: The least part of a language's texts that a cluster holds; two texts at least.
LEAST_CLUSTER = 0.1
LANGUAGES_MOST = 256
JUDGED = pa.struct([("lang_pred", pa.string()), ("score", pa.float64()), ("rejected", pa.bool_())])
OTHER = re.compile(r"[\W\d_]+")


def letters(text: str | None) -> str:
    """Lower-cased letters (with their combining marks left out) and single blanks around and between the runs of them."""
    kept = OTHER.sub(" ", (text or "").lower())
    return f" {kept.strip()} " if kept.strip() else ""


def has_letter(text: str | None) -> bool:
    return bool(text) and any(map(str.isalpha, text))


def gram_counts(text: str, dimensions: int = DIMENSIONS) -> np.ndarray:
    """Hashed counts of the n-grams of one to three characters, over the whole text."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint32)
    out = np.zeros(dimensions, np.int64)
    for begin in range(0, len(codes), PIECE):
        c = codes[begin:begin + PIECE + 2]
        own = min(PIECE, len(codes) - begin)
        h = c * np.uint32(0x9E3779B1)
        for n in (1, 2, 3):
            if n > 1:
                h = (h[:-1] ^ (h[:-1] >> np.uint32(15))) * np.uint32(0x85EBCA77) + c[n - 1:] * np.uint32(0xC2B2AE3D)
            mixed = h[:own] ^ (h[:own] >> np.uint32(13))
            mixed = mixed * np.uint32(0x27D4EB2F) + np.uint32(n)
            out += np.bincount((mixed >> np.uint32(16)) % np.uint32(dimensions), minlength=dimensions)
    return out


class Centroids:
    """A fitted classifier: small enough to go to every task (languages x CENTROIDS x DIMENSIONS numbers)."""

    def __init__(self, langs: list[str], owner: np.ndarray, vectors: np.ndarray, idf: np.ndarray, limits: np.ndarray):
        self.langs, self.owner, self.vectors, self.idf, self.limits = langs, owner, vectors, idf, limits

    def weigh(self, counts: np.ndarray) -> np.ndarray:
        v = np.sqrt(counts) * self.idf
        norm = np.sqrt((v ** 2).sum(-1, keepdims=True))
        return v / np.where(norm == 0, 1, norm)

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        """(language, score, rejected)."""
        if not self.langs or not has_letter(text):
            return UNKNOWN, 0.0, True
        counts = gram_counts(letters(text))
        used = np.flatnonzero(counts)
        v = np.sqrt(counts[used]) * self.idf[used]
        norm = np.sqrt((v ** 2).sum())
        cosines = self.vectors[:, used] @ v / norm if norm else np.zeros(len(self.owner))
        best = int(cosines.argmax())
        score = float(min(max(cosines[best], 0.0), 1.0))
        return self.langs[self.owner[best]], score, bool(1 - score > self.limits[self.owner[best], band(len(used))])


def band(grams: int) -> int:
    """Texts of 2 ** n to 2 ** (n + 1) - 1 distinct n-grams are one band."""
    return max(int(grams).bit_length() - 1, 0)


def band_limits(own: np.ndarray, distances: np.ndarray, grams: np.ndarray) -> np.ndarray:
    """The distance beyond which a text of each band is rejected, from the training texts' distances; `own` are those of the language."""
    of = np.array([band(g) for g in grams], np.int64)
    out, limit = np.empty(BANDS), REJECT_MOST
    for b in range(BANDS):
        here = distances[(of == b) & own]
        here = here if len(here) >= BAND_TEXTS else distances[of == b]
        if len(here) >= BAND_TEXTS:
            limit = min(REJECT_MOST, (1 + np.quantile(here, REJECT_QUANTILE, method="lower")) / 2)
        out[b] = limit
    return out


def _halved(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers below and above the median along the direction of the largest spread (a few power steps find it well enough)."""
    away = x - x.mean(0)
    along = away[np.argmax((away ** 2).sum(1))]
    for _ in range(STEPS):
        along = away.T @ (away @ along)
        along /= max(np.sqrt((along ** 2).sum()), 1e-12)
    order = np.argsort(away @ along, kind="stable")
    return order[:len(x) // 2], order[len(x) // 2:]


def _means(x: np.ndarray, k: int) -> np.ndarray:
    """At most k centroids of the rows, and at least two where there are four rows: balanced halves first, then spherical k-means."""
    least = max(2, LEAST_CLUSTER * len(x))
    parts = [np.arange(len(x))]
    while len(parts) < k:
        widest = max(range(len(parts)), key=lambda i: (len(parts[i]), -i))
        if len(parts[widest]) // 2 < least:
            break
        parts[widest:widest + 1] = [parts[widest][half] for half in _halved(x[parts[widest]])]

    def directions(groups):
        centre = np.stack([x[g].sum(0) for g in groups])
        return centre / np.maximum(np.sqrt((centre ** 2).sum(1, keepdims=True)), 1e-12)

    centre = directions(parts)
    for _ in range(STEPS):
        nearest = (x @ centre.T).argmax(1)
        groups = [np.flatnonzero(nearest == j) for j in range(len(centre))]
        if min(map(len, groups)) < least:
            break
        centre = directions(groups)
    return centre


def training_rows(docs: DataFrame, per_language: int = SAMPLE_PER_LANGUAGE) -> DataFrame:
    """(lang, text) of the sample: per language the different rows (id, text) with the smallest hashes.

    A language's rows with a letter are counted before, and rows whose hash lies far beyond the sample's expected range don't go to the window, so a large
    language costs it no more than a small one. Where copies make up so much of a language that too few different rows come back, the
    range is widened, up to all its rows. Rows are chosen first, then their texts read, each once.
    """
    lettered = docs.where(F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & F.col("text").rlike(r"\p{L}")).select("lang", "doc_id", "text", F.xxhash64("text").alias("text_hash"))
    hashed = F.xxhash64(F.lit("sample"), "doc_id", "text_hash")
    place = (hashed.cast("double") + 2.0 ** 63) / 2.0 ** 64
    counts = cut_lineage(lettered.groupBy("lang").agg(F.count(F.lit(1)).alias("rows")), "lang-counts")
    if counts.count() > LANGUAGES_MOST:
        raise ValueError(f"more than {LANGUAGES_MOST} languages")
    order = Window.partitionBy("lang").orderBy("hash", "doc_id", "text_hash")
    chosen, margin, open_ = None, HASH_MARGIN, counts
    while True:
        near = lettered.select("lang", "doc_id", "text_hash", hashed.alias("hash"), place.alias("place")).join(open_, "lang").where(F.col("place") * F.col("rows") < margin * per_language)
        distinct = near.groupBy("lang", "doc_id", "text_hash", "hash").agg(F.count(F.lit(1)).alias("copies"))
        found = cut_lineage(distinct.withColumn("n", F.row_number().over(order)).where(F.col("n") <= per_language).select("lang", "doc_id", "text_hash"), "lang-chosen")
        enough = found.groupBy("lang").agg(F.count(F.lit(1)).alias("got"))
        short = open_.join(enough, "lang", "left").where((F.coalesce("got", F.lit(0)) < per_language) & (F.col("rows") > margin * per_language)).select("lang", "rows")
        short = cut_lineage(short, "lang-short")
        kept = found.join(short, "lang", "left_anti")
        chosen = kept if chosen is None else chosen.unionByName(kept)
        if short.isEmpty():
            break
        open_, margin = short, margin * HASH_MARGIN
    wanted = chosen.select(F.col("lang").alias("of"), F.col("doc_id").alias("id"), F.col("text_hash").alias("hash"))
    # at most `per_language` rows for each of at most LANGUAGES_MOST languages: bounded, so the texts need not be shuffled
    texts = lettered.join(F.broadcast(wanted), (F.col("doc_id") == F.col("id")) & (F.col("lang") == F.col("of")) & (F.col("text_hash") == F.col("hash")))
    return texts.dropDuplicates(["lang", "doc_id", "text_hash"]).select("lang", "text")


def fit(docs: DataFrame, per_language: int = SAMPLE_PER_LANGUAGE, k: int = CENTROIDS) -> Centroids:
    """Fits on a bounded sample of `docs` (doc_id, text, lang). Counting and clustering run per language in tasks."""
    def count(batches):
        for batch in batches:
            counts = [gram_counts(letters(t)) for t in batch["text"]]
            used = [np.flatnonzero(c) for c in counts]
            yield pd.DataFrame({"lang": batch["lang"], "grams": [u.astype(np.int32).tobytes() for u in used],
                                "counts": [c[u].astype(np.int64).tobytes() for c, u in zip(counts, used)]})

    counted = cut_lineage(training_rows(docs, per_language).mapInPandas(count, "lang string, grams binary, counts binary"), "lang-sample")

    def frequencies(batches):
        total, n = np.zeros(DIMENSIONS, np.int64), 0
        for batch in batches:
            for g in batch["grams"]:
                total[np.frombuffer(g, np.int32)] += 1
                n += 1
        yield pd.DataFrame({"total": [total.tobytes()], "n": [n]})

    parts = counted.mapInPandas(frequencies, "total binary, n bigint").collect()  # one vector per task of a bounded sample
    n = sum(p["n"] for p in parts)
    found = sum((np.frombuffer(p["total"], np.int64) for p in parts), np.zeros(DIMENSIONS, np.int64))
    idf = np.log((1 + n) / (1 + found)) + 1

    def cluster(rows: pd.DataFrame) -> pd.DataFrame:
        x = np.zeros((len(rows), DIMENSIONS))
        rows = rows.sort_values(["grams", "counts"])
        for i, (g, c) in enumerate(zip(rows["grams"], rows["counts"])):
            x[i, np.frombuffer(g, np.int32)] = np.sqrt(np.frombuffer(c, np.int64))
        x *= idf
        x /= np.maximum(np.sqrt((x ** 2).sum(1, keepdims=True)), 1e-12)
        centre = _means(x, k)
        far, grams = 1 - (x @ centre.T).max(1), (x > 0).sum(1).astype(np.int64)
        return pd.DataFrame({"lang": rows["lang"].iloc[0], "centre": [c.tobytes() for c in centre], "far": far.tobytes(), "grams": grams.tobytes()})

    rows = sorted(counted.groupBy("lang").applyInPandas(cluster, "lang string, centre binary, far binary, grams binary").collect(), key=lambda r: (r["lang"], r["centre"]))
    langs = sorted({r["lang"] for r in rows})
    owner = np.array([langs.index(r["lang"]) for r in rows], np.int64)
    trained = {r["lang"]: (np.frombuffer(r["far"], np.float64), np.frombuffer(r["grams"], np.int64)) for r in rows}  # of the bounded sample
    of = np.repeat(np.arange(len(langs)), [len(trained[x][0]) for x in langs])
    far, grams = (np.concatenate([trained[x][i] for x in langs]) if langs else np.empty(0) for i in (0, 1))
    limits = np.array([band_limits(of == i, far, grams) for i in range(len(langs))]).reshape(-1, BANDS)
    vectors = np.stack([np.frombuffer(r["centre"], np.float64) for r in rows]) if rows else np.zeros((0, DIMENSIONS))
    return Centroids(langs, owner, vectors, idf, limits)


def judged(docs: DataFrame, model: Centroids, found: str) -> DataFrame:
    """`docs` with `found`, a struct of lang_pred, score and rejected."""
    sent = docs.sparkSession.sparkContext.broadcast(model)  # bounded by its construction
    kind = T.StructType([T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("rejected", T.BooleanType())])
    at = docs.columns.index("text")

    def judge(batches):
        for batch in slices(batches):
            out = [dict(zip(("lang_pred", "score", "rejected"), sent.value.predict(t.as_py()))) for t in batch.column(at)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, JUDGED)], [*batch.schema.names, found])

    return docs.mapInArrow(releasing(judge), T.StructType([*docs.schema.fields, T.StructField(found, kind)]))


def unused(columns: list[str], name: str) -> str:
    """A column name that the table does not have."""
    while name.lower() in map(str.lower, columns):
        name += "_"
    return name


def predict(docs: DataFrame, model: Centroids, *carry: str) -> DataFrame:
    """lang_pred, score and rejected for every row, beside the carried columns."""
    found = unused(docs.columns, "__lang")
    rows = judged(docs.select("text", *[F.col(f"`{c}`") for c in carry if c != "text"]), model, found)
    return rows.select(*[F.col(f"`{c}`") for c in carry], f"`{found}`.*")


def keep_identified(docs: DataFrame, model: Centroids) -> DataFrame:
    """The rows that are not rejected, as they are."""
    found = unused(docs.columns, "__lang")
    return judged(docs, model, found).where(~F.col(f"`{found}`.rejected")).drop(found)


def held_out(doc_id: Column) -> Column:
    """Rows that the query does not learn from: crc32 of the id as text leaves 2 when divided by 4."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))
