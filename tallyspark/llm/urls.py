"""URL rules: a blocked Bloom filter passes possible hits to an exact hash join.

Every rule is a canonical URL (host and path). A URL asks for the rules that could fit it: its last k host labels joined with the first
n characters of its path, for each (k, n) that some rule has. The filter drops most of these keys, the join on the whole key decides.
URLs without a possible key are not shuffled at all; the others are reduced to their longest rule. The number of keys a URL asks for
depends on the rules only, not on the length of the URL. DataFrame functions only.

The filter grows with the list, `KEYS_PER_WORD` rules for each word of 64 bits. Up to `SENT_WORDS` words it goes to every task as one
array; the filter of a longer list stays a table, which the keys meet by their word's number before they go to the exact join.

Nulls and odd input: a null URL or one without `://` has an empty host and path and fits no rule; an empty table gives an empty result;
repeated rows are judged one by one; other columns are not read. Equal rules with both verdicts block.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, functions as F

from ..session import cut_lineage

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Words of 64 bits that a filter may have to be sent to all tasks: 32 MB, for 16 million rules.
SENT_WORDS = 1 << 22
KEYS_PER_WORD = 4
BITS_PER_KEY = 4


def host_of(url: Column) -> Column:
    return F.coalesce(F.translate(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def _word(key: Column, words: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(words))


def _mask(key: Column) -> Column:
    bits = F.xxhash64(F.lit("bits"), key)
    mask = F.lit(0).cast("long")
    for i in range(BITS_PER_KEY):
        place = F.shiftrightunsigned(bits, 6 * i).bitwiseAND(F.lit(63)).cast("int")
        mask = mask.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), place))
    return mask


def bloom_size(keys: DataFrame) -> int:
    """Words that the filter of the keys needs."""
    n, words = keys.count(), 1
    while words * KEYS_PER_WORD < n:
        words *= 2
    return words


def bloom_table(keys: DataFrame, words: int, column: str = "key") -> DataFrame:
    """(word_no, word): the words of the filter that have a bit."""
    return keys.groupBy(_word(F.col(column), words).alias("word_no")).agg(F.bit_or(_mask(F.col(column))).alias("word"))


def bloom_array(table: DataFrame, words: int) -> DataFrame:
    """One row with all words of a filter in order."""
    every = table.sparkSession.range(words).join(table, F.col("id") == F.col("word_no"), "left")
    entries = F.sort_array(F.collect_list(F.struct("id", F.coalesce("word", F.lit(0).cast("long")).alias("word"))))
    return every.agg(F.transform(entries, lambda x: x["word"]).alias("words"))


def may_hold(words: Column, n_words: int, key: Column) -> Column:
    mask = _mask(key)
    return F.element_at(words, (_word(key, n_words) + 1).cast("int")).bitwiseAND(mask) == mask


def judge_urls(pages: DataFrame, rules: DataFrame, id_col: str = "page_id", url_col: str = "url", sent_words: int = SENT_WORDS) -> DataFrame:
    """(id, host, path, rule, verdict) per row of `pages`.

    `rules`: host, path, verdict (allow or block). A rule fits its host and all subdomains if the path starts with the rule's path; the
    longest rule wins; where none fits, the URL is not listed and is allowed. The rules' distinct (labels, path length) pairs are read
    to the driver: there are at most as many as label counts times path lengths, which URLs bound, however long the list is.
    """
    listed = rules.select(F.concat("host", "path").alias("key"), F.col("verdict"), F.size(F.split("host", r"\.")).alias("labels"),
                          F.length("path").alias("chars")).where(F.col("key").isNotNull())
    listed = cut_lineage(listed.groupBy("key", "labels", "chars").agg(F.max("verdict").alias("verdict")), "url-rules")
    shapes = [(r.labels, r.chars) for r in listed.select("labels", "chars").distinct().sort("labels", "chars").collect()]
    urls = pages.select(F.col(id_col).alias("page_id"), host_of(F.col(url_col)).alias("host"), path_of(F.col(url_col)).alias("path"))
    unlisted = {"rule": F.lit(None).cast("string"), "verdict": F.lit("allow")}
    if not shapes:
        return urls.withColumns(unlisted)
    words = bloom_size(listed)
    table = cut_lineage(bloom_table(listed, words), "url-filter")
    # all shapes are one literal and one expression, however many there are
    asked = F.from_json(F.lit(json.dumps([{"k": k, "n": n} for k, n in shapes])), "array<struct<k:int,n:int>>")
    dots = F.length("host") - F.length(F.replace(F.col("host"), F.lit("."), F.lit("")))
    fitting = F.filter(asked, lambda s: (F.col("dots") + 1 >= s["k"]) & (F.length("path") >= s["n"]))
    keys = F.transform(fitting, lambda s: F.concat(F.call_function("substring_index", F.col("host"), F.lit("."), -s["k"]), F.substring(F.col("path"), F.lit(1), s["n"])))
    urls = urls.withColumn("dots", dots).withColumn("row_id", F.monotonically_increasing_id())
    if words <= sent_words:
        urls = urls.withColumn("words", cut_lineage(bloom_array(table, words), "url-filter-array").scalar())
        urls = urls.withColumn("possible", F.filter(keys, lambda key: may_hold(F.col("words"), words, key))).drop("words")
    else:
        urls = _possible_by_table(urls.withColumn("asked", keys), table, words)
    apart = urls.where(F.size("possible") == 0).select("page_id", "host", "path").withColumns(unlisted)
    keyed = urls.where(F.size("possible") > 0).select("row_id", "page_id", "host", "path", F.explode("possible").alias("key"))
    hits = keyed.join(listed.select("key", "verdict"), "key", "left")
    best = F.max(F.when(F.col("verdict").isNotNull(), F.struct(F.length("key").alias("n"), F.col("key"), F.col("verdict"))))
    judged = hits.groupBy("row_id", "page_id", "host", "path").agg(best.alias("best"))
    return apart.unionByName(judged.select("page_id", "host", "path", F.col("best.key").alias("rule"), F.coalesce("best.verdict", F.lit("allow")).alias("verdict")))


def _possible_by_table(urls: DataFrame, table: DataFrame, words: int) -> DataFrame:
    """`urls` with `possible`, the keys in `asked` that the filter lets through, where the filter is too large to be sent."""
    urls = cut_lineage(urls, "urls-asked")
    keys = urls.select("row_id", F.explode("asked").alias("key")).withColumns({"word_no": _word(F.col("key"), words), "mask": _mask(F.col("key"))})
    through = keys.join(table, "word_no").where(F.col("word").bitwiseAND(F.col("mask")) == F.col("mask"))
    found = through.groupBy("row_id").agg(F.collect_list("key").alias("possible"))  # at most one key for each shape
    return urls.join(found, "row_id", "left").withColumn("possible", F.coalesce("possible", F.array().cast("array<string>")))
