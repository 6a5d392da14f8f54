"""From raw documents to tokens: five stages, each a training-data operator over all that the stage before it kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tallyspark.llm import langid, mixing, pieces, simhash, suffix
from tallyspark.session import cut_lineage

#: Some stages have no SQL counterpart; tests compare run() with brute force.
ORACLE_SQL = None


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is identified; the classifier is fitted on labelled rows that are not held out."""
    return langid.keep_identified(docs, langid.fit(docs.where(~langid.held_out(F.col("doc_id")))))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component."""
    return simhash.keep_one_each(docs)


def repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the 50-byte strings that a document with a smaller id has."""
    return suffix.keep_first_occurrences(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them, whole, by shard and in the shard's order."""
    return mixing.mix_documents(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids (packed, little-endian, 32 bits), and digests of ids and decoded text."""
    import public_tokenizers

    coded = pieces.tokenize(docs, public_tokenizers.path("piece_bpe_32k.model"), keep_words=False)
    return coded.select("doc_id", "n_tokens", "ids", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [("language", language), ("near_duplicates", near_duplicates), ("repeats", repeats), ("mix", mix), ("tokens", tokens)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = cut_lineage(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
