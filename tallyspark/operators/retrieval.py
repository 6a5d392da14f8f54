"""Ranked lookup of documentation by vector similarity and keywords, and column statistics."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F, types as T

from ..session import cut_lineage


def cosine(column: str, query: list[float]):
    """Cosine of an array column with a fixed query vector, inside generated code."""
    v = F.transform(F.col(column), lambda x: x.cast("double"))
    q = F.array(*[F.lit(float(x)) for x in query])
    dot = F.aggregate(F.zip_with(v, q, lambda a, b: a * b), F.lit(0.0), lambda acc, x: acc + x)
    norm = F.sqrt(F.aggregate(v, F.lit(0.0), lambda acc, x: acc + x * x))
    size = sum(x * x for x in query) ** 0.5
    return F.try_divide(dot, norm * F.lit(size))


def keyword_share(column: str, words: list[str]):
    text = F.lower(F.col(column))
    hits = sum((F.contains(text, F.lit(w.lower())).cast("int") for w in words), F.lit(0))
    return hits.cast("double") / len(words)


def top_matches(docs: DataFrame, query: list[float], words: list[str], k: int, vector="embedding", text="text", ident="doc_id",
                weight: float = 0.7) -> DataFrame:
    """Best k documents; each task keeps k rows and only those meet."""
    score = F.round(weight * cosine(vector, query) + (1 - weight) * keyword_share(text, words), 6)
    return docs.select(ident, score.alias("score")).orderBy(F.col("score").desc(), ident).limit(k)


QUESTIONS_AT_ONCE = 2048


def _half_up(x: np.ndarray) -> np.ndarray:
    """Six digits, halves away from zero, like SQL."""
    return np.sign(x) * np.floor(np.abs(x) * 1e6 + 0.5) / 1e6


def _best_of_block(questions: list, k: int, weight: float):
    """Scores batches of documents (ident, text, vector) against a block of questions and keeps a running best k per question."""
    asked = np.array([q["vector"] for q in questions], float)
    asked /= np.maximum(np.sqrt((asked ** 2).sum(1, keepdims=True)), 1e-300)
    words = sorted({w.lower() for q in questions for w in q["words"]})
    of_word = np.zeros((len(words), len(questions)))
    for i, q in enumerate(questions):
        for w in q["words"]:
            of_word[words.index(w.lower()), i] += 1 / len(q["words"])

    def run(batches):
        best: list[list] = [[] for _ in questions]
        least = np.full(len(questions), -np.inf)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                ident, text, vector = (c.to_pylist() for c in batch.slice(at, 256).columns)
                rows = [i for i, v in enumerate(vector) if v is not None and len(v) == asked.shape[1] and None not in v and any(v)]
                if not rows:
                    continue
                x = np.array([vector[i] for i in rows], float)
                cosines = (x / np.sqrt((x ** 2).sum(1, keepdims=True))) @ asked.T
                has = np.array([[w in (text[i] or "").lower() for w in words] for i in rows], float).reshape(len(rows), len(words))
                scores = _half_up(weight * cosines + (1 - weight) * (has @ of_word)).T
                for q in np.flatnonzero((scores >= least[:, None]).any(1)):
                    near = [(-scores[q, j], ident[rows[j]]) for j in np.flatnonzero(scores[q] >= least[q])]
                    best[q] = sorted(best[q] + near)[:k]
                    least[q] = -best[q][-1][0] if len(best[q]) == k else -np.inf
        found = [(q["question_id"], i, -s) for q, b in zip(questions, best) for s, i in b]
        if found:
            a, b, c = zip(*found)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(c, pa.float64())], ["question_id", "ident", "score"])
    return run


def top_matches_many(docs: DataFrame, questions: DataFrame, k: int, vector="embedding", text="text", ident="doc_id", weight: float = 0.7) -> DataFrame:
    """(question_id, place, ident, score): the best k documents of every question (question_id, vector, words), like top_matches.

    Questions go out in blocks of about QUESTIONS_AT_ONCE, each in one pass over the documents; a task keeps k rows per question of the block, and only
    those meet. Documents whose vector is null, zero or of another length take no part; ids are whole numbers and not null.
    """
    blocks = max(1, math.ceil(questions.count() / QUESTIONS_AT_ONCE))
    dealt = cut_lineage(questions.withColumn("_block", F.pmod(F.xxhash64("question_id"), F.lit(blocks))), "questions")
    rows, found = docs.where(F.col(ident).isNotNull()).select(F.col(ident).cast("bigint"), text, vector), None
    for block in range(blocks):
        asked = [r.asDict() for r in dealt.where(F.col("_block") == block).select("question_id", "vector", "words").collect()]
        if asked:
            part = cut_lineage(rows.mapInArrow(_best_of_block(asked, k, weight), "question_id bigint, ident bigint, score double"), "matches")
            found = part if found is None else found.unionByName(part)
    if found is None:
        return docs.sparkSession.createDataFrame([], f"question_id bigint, place int, {ident} bigint, score double")
    place = F.row_number().over(Window.partitionBy("question_id").orderBy(F.col("score").desc(), "ident"))
    return found.withColumn("place", place).where(F.col("place") <= k).select("question_id", "place", F.col("ident").alias(ident), "score")


def column_profile(df: DataFrame) -> DataFrame:
    """Type, nulls, distinct values and range of every column.

    Cells are counted per (column, value) first, so equal values combine before the shuffle and no column sits in one task.
    """
    def text(f: T.StructField):
        return (F.col(f.name).cast("decimal(18,2)") if isinstance(f.dataType, (T.DoubleType, T.FloatType)) else F.col(f.name)).cast("string")

    fields = [f for f in df.schema.fields if not isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType))]
    cells = df.select(F.explode(F.array(*[F.struct(F.lit(f.name).alias("column_name"), F.lit(f.dataType.simpleString()).alias("data_type"), text(f).alias("v"))
                                          for f in fields])).alias("c")).select("c.*")
    per_value = cells.groupBy("column_name", "data_type", "v").agg(F.count("*").alias("n"))
    return per_value.groupBy("column_name", "data_type").agg(
        F.sum("n").alias("rows"), F.coalesce(F.sum(F.when(F.col("v").isNull(), F.col("n"))), F.lit(0)).alias("nulls"), F.count("v").alias("distinct_values"),
        F.min("v").alias("min_text"), F.max("v").alias("max_text"))
