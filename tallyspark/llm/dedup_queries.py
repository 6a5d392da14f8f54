"""Queries of the operators that SQL cannot express; tests compare them with brute force."""

from __future__ import annotations

from pyspark.sql import functions as F

from . import langid, pieces, simhash, suffix
from .registry import query, table


@query("op6_simhash")
def op6_simhash(spark, sf_dir):
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.as_hex(F.col("fp")).alias("fingerprint"), "component_id")


@query("op3_suffix")
def op3_suffix(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    cut = suffix.remove_repeats(docs, with_text=False)
    return cut.select("doc_id", F.col("__n_bytes").alias("n_bytes"), F.col("__n_removed").alias("n_removed"),
                      F.size("__spans").cast("bigint").alias("n_spans"), F.col("__kept_sha256").alias("kept_sha256"))


@query("op7_pieces")
def op7_pieces(spark, sf_dir):
    import public_tokenizers
    return pieces.token_digests(pieces.tokenize(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model")))


@query("op8_langid")
def op8_langid(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang").withColumn("held_out", langid.held_out(F.col("doc_id")))
    model = langid.fit(docs.where(~F.col("held_out")))
    return langid.predict(docs, model, "doc_id", "held_out")
