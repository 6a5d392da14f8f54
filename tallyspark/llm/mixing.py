"""Mixing sources to target weights, by a multivariate-hypergeometric splitting tree.

A block is one document in one pass over its source. Every source has a quota of blocks: whole passes, then the first documents of a
permutation of the source, until its words are as near to the target as whole documents allow. The tree halves the output shards again
and again and splits the quotas of all sources between the halves: a multivariate hypergeometric draw, as if the blocks had been
shuffled and cut in the middle, so that both the sources' quotas and the shards' sizes stay exact. A shard's share of a source is a range of
the source's permuted blocks: shards are disjoint, and a document is in the mix because a shard drew a block of it. Within a shard
blocks are shuffled by a hash. `mix_documents` writes the mix by shard, in that order; `MixPlan.blocks_of` tells shard and order.

The permutation orders by a hash of id and text. Equal rows are one group with a count, so copies and null ids never crowd a window; a
group's copies follow each other in the permutation. Ranks come from sums per (source, hash bucket) and a window over the groups of a
bucket; every source has as many buckets as its groups need. The tree works on counts per source: draws go down a tree of pages of
`PAGE` sources, so that no row holds more than a page. A source's targets are found among one row per source. DataFrame functions
only.

Nulls and odd input: a null text has size 0 and is never taken; a null source is a source of its own, last in order; null ids are
documents; repeated rows are separate documents (equal ones may change places); an empty table gives an empty result; other columns are
carried along by `mix_documents`. Texts are taken whole or not at all. Reruns agree, as every choice is a hash of `seed`.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import cut_lineage

SPACE = " \t\n\u000b\u000c\r"
WEIGHTS = (3, 1, 2)
SHARE, MOST = 1.5, 2
ROWS_PER_BUCKET = 1024
BLOCKS_PER_SHARD = 8192
#: Of eight-deviation proposals about one in six is accepted: all of these are refused less than twice in a hundred thousand draws.
TRIALS = 64
PAGE = 256
COPIES_AT_ONCE = 100_000


def word_count(text: Column) -> Column:
    """Number of runs outside space and \\t to \\r; null counts 0."""
    spaced = F.rtrim(text, F.lit(SPACE))
    return F.coalesce(F.length(F.regexp_replace(spaced, r"[\x20\x09-\x0D]*+[^\x20\x09-\x0D]++", "x")), F.lit(0)).cast("bigint")


def _let(value: Column, use) -> Column:
    return F.element_at(F.transform(F.array(value), use), 1)


def _log_factorial(n: Column) -> Column:
    x = F.greatest(n, F.lit(16)).cast("double")
    series = x * F.log(x) - x + 0.5 * F.log(2 * math.pi * x) + 1 / (12 * x) - 1 / (360 * x * x * x)
    small = F.array(*[F.lit(math.lgamma(i + 1)) for i in range(17)])
    return F.when(n <= 16, F.element_at(small, F.least(n, F.lit(16)).cast("int") + 1)).otherwise(series)


def _uniform(*parts: Column) -> Column:
    """In (0, 1), from a hash."""
    return (F.shiftrightunsigned(F.xxhash64(*parts), 12).cast("double") + 0.5) / float(2 ** 52)


def hypergeometric(total: Column, good: Column, draws: Column, seed: Column, trials: int = TRIALS) -> Column:
    """How many of `draws` items out of `total` are among the `good` ones: rejection from a uniform proposal within eight deviations.

    The first accepted trial counts; if all are refused, the value is found by inversion: the weights of the values in reach are added up
    until they pass a uniform share of their sum.
    """
    def narrow(p):
        mean = p["draws"] * p["good"] / p["total"]
        spread = mean * (p["total"] - p["good"]) / p["total"] * (p["total"] - p["draws"]) / F.greatest(p["total"] - 1, F.lit(1))
        reach = 8 * F.sqrt(spread) + 8
        least = F.greatest(F.lit(0), p["draws"] + p["good"] - p["total"])
        most = F.least(p["good"], p["draws"])
        mode = F.floor((p["draws"] + 1.0) * (p["good"] + 1.0) / (p["total"] + 2.0))
        return F.struct(p["total"].alias("total"), p["good"].alias("good"), p["draws"].alias("draws"), p["seed"].alias("seed"),
                        F.greatest(least, F.floor(mean - reach)).alias("a"), F.least(most, F.ceil(mean + reach)).alias("b"),
                        F.least(most, F.greatest(least, mode)).alias("mode"))

    def weigh(p, x):
        return -(_log_factorial(x) + _log_factorial(p["good"] - x) + _log_factorial(p["draws"] - x)
                 + _log_factorial(p["total"] - p["good"] - p["draws"] + x))

    def draw(p):
        def propose(i):
            return p["a"] + F.floor(_uniform(p["seed"], i, F.lit("place")) * (p["b"] - p["a"] + 1))

        def accepted(x, i, top):
            return F.log(_uniform(p["seed"], i, F.lit("height"))) <= weigh(p, x) - top

        tries = F.sequence(F.lit(1), F.lit(trials)) if trials else F.array().cast("array<int>")
        places = F.transform(tries, lambda i: F.struct(i.alias("i"), propose(i).alias("x")))
        def inverted(top):
            weights = F.transform(F.sequence(p["a"], p["b"]), lambda x: F.struct(x.alias("x"), F.exp(weigh(p, x) - top).alias("w")))
            total = F.aggregate(weights, F.lit(0.0), lambda sum_, v: sum_ + v["w"])
            begin = F.struct((total * _uniform(p["seed"], F.lit("inversion"))).alias("left"), F.lit(None).cast("bigint").alias("x"))
            return F.aggregate(weights, begin, lambda seen, v: F.struct(
                (seen["left"] - v["w"]).alias("left"), F.coalesce(seen["x"], F.when(seen["left"] <= v["w"], v["x"])).alias("x")), lambda seen: F.coalesce(seen["x"], p["mode"]))

        return _let(weigh(p, p["mode"]), lambda top: F.coalesce(
            F.get(F.filter(places, lambda t: accepted(t["x"], t["i"], top)), F.lit(0))["x"], inverted(top)))

    p = F.struct(total.cast("bigint").alias("total"), good.cast("bigint").alias("good"), draws.cast("bigint").alias("draws"), seed.alias("seed"))
    certain = F.when((good == 0) | (draws == 0), F.lit(0).cast("bigint")).when(draws == total, good).when(good == total, draws)
    return F.coalesce(certain, _let(_let(p, narrow), draw)).cast("bigint")


def _draw_page(items: Column, draws: Column, seed: Column) -> Column:
    """array<struct<item, blocks, left>>: how many of `draws` blocks come from each of the items (item, blocks), one after the other."""
    kept = "array<struct<item:bigint,blocks:bigint,left:bigint>>"
    begin = F.struct(F.aggregate(items, F.lit(0).cast("bigint"), lambda a, i: a + i["blocks"]).alias("total"), draws.cast("bigint").alias("draws"), F.array().cast(kept).alias("found"))

    def step(seen, i):
        x = hypergeometric(seen["total"], i["blocks"], seen["draws"], F.xxhash64(seed, i["item"]))
        return _let(x, lambda got: F.struct((seen["total"] - i["blocks"]).alias("total"), (seen["draws"] - got).alias("draws"), F.concat(seen["found"], F.array(
            F.struct(i["item"].alias("item"), i["blocks"].alias("blocks"), got.alias("left"))).cast(kept)).alias("found")))

    return F.aggregate(items, begin, step, lambda seen: seen["found"])


def _pages(rows: DataFrame) -> DataFrame:
    """(shard, page, items) from (shard, item, blocks): the items of a page in order."""
    page = F.floor(F.col("item") / PAGE).cast("bigint").alias("page")
    return rows.groupBy("shard", page).agg(F.sort_array(F.collect_list(F.struct("item", "blocks"))).alias("items"))


def split_quotas(quotas: DataFrame, depth: int, seed: int, sources: int) -> DataFrame:
    """(shard, place, blocks): the quotas (place, blocks) of all sources, split among 2 ** depth shards of equal size (one block apart).

    Per level of the tree, half of each node's blocks is drawn from the pages of the sources, then each page's draws from its sources.
    """
    nodes = quotas.where("blocks > 0").select(F.lit(0).cast("bigint").alias("shard"), F.col("place").cast("bigint").alias("item"), "blocks")
    for level in range(depth):
        levels = [nodes]
        while sources > PAGE ** len(levels):
            levels.append(levels[-1].groupBy("shard", F.floor(F.col("item") / PAGE).cast("bigint").alias("item")).agg(F.sum("blocks").alias("blocks")))
        drawn = None
        for height in reversed(range(len(levels))):
            paged = _pages(levels[height])
            if drawn is None:
                half = F.floor(F.aggregate("items", F.lit(0).cast("bigint"), lambda a, i: a + i["blocks"]) / 2)
                paged = paged.withColumn("draws", half)
            else:
                paged = paged.join(drawn.select("shard", F.col("item").alias("page"), F.col("left").alias("draws")), ["shard", "page"])
            found = _draw_page(F.col("items"), F.col("draws"), F.xxhash64(F.lit(seed), F.lit(level), F.lit(height), F.col("shard")))
            drawn = cut_lineage(paged.select("shard", F.explode(found).alias("f")).select("shard", "f.*"), "mix-draws")
        half = lambda shard, blocks: F.struct(shard.alias("shard"), F.col("item"), blocks.alias("blocks"))
        nodes = drawn.select(F.explode(F.array(half(F.col("shard") * 2, F.col("left")), half(F.col("shard") * 2 + 1, F.col("blocks") - F.col("left")))).alias("n")).select("n.*").where("blocks > 0")
    return nodes.select("shard", F.col("item").cast("int").alias("place"), "blocks")


def _keyed(docs: DataFrame, seed: int) -> DataFrame:
    """Adds mix_src, mix_key and size to `docs`."""
    text_hash = F.coalesce(F.md5(F.col("text").cast("binary")), F.lit("-"))
    return docs.withColumns({
        "mix_src": F.coalesce(F.concat(F.lit("s"), F.col("source")), F.lit("n")),
        "mix_key": F.md5(F.concat_ws("|", F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit("-")), text_hash).cast("binary"))})


def source_targets(by_source: DataFrame) -> DataFrame:
    """(mix_src, place, docs, source_size, target, passes, rest) from (mix_src, source, source_size, docs), one row per source.

    Targets share 150 % of all words by weight, up to twice a source's size; what is cut off goes to the others by weight. That is one
    level: sources in the order of cap per weight are full until the level of the rest lies below their cap.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    rank = F.row_number().over(order) - 1
    weight = F.element_at(F.array(*[F.lit(w) for w in WEIGHTS]), (rank % len(WEIGHTS)).cast("int") + 1)
    s = by_source.select("*", rank.cast("int").alias("place"), weight.alias("weight"), (MOST * F.col("source_size")).alias("cap"))
    fill = Window.orderBy(F.col("cap") / F.col("weight"), "place")
    everything = Window.partitionBy()
    s = s.withColumns({
        "all_words": F.sum("source_size").over(everything),
        "full": F.coalesce(F.sum("cap").over(fill.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)),
        "open": F.sum("weight").over(fill.rowsBetween(0, Window.unboundedFollowing)),
    }).withColumn("level", (SHARE * F.col("all_words") - F.col("full")) / F.col("open"))
    s = s.withColumn("water", F.first(F.when(F.col("cap") / F.col("weight") >= F.col("level"), F.col("level")), ignorenulls=True).over(
        fill.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
    target = F.least(F.coalesce(F.col("water") * F.col("weight"), F.col("cap").cast("double")), F.col("cap").cast("double"))
    s = s.withColumn("target", target)
    words = F.floor(F.col("target") + 0.5).cast("bigint")
    passes = F.when(F.col("source_size") > 0, F.least(F.floor(words / F.col("source_size")), F.lit(MOST))).otherwise(0).cast("bigint")
    return s.select("mix_src", "place", "docs", "source_size", "target", passes.alias("passes"), (words - passes * F.col("source_size")).alias("rest"))


class MixPlan:
    """What a mix of `docs` takes: targets, the permutation's bucket sums and the shards' ranges; without texts."""

    def __init__(self, docs: DataFrame, seed: int = 4, blocks_per_shard: int = BLOCKS_PER_SHARD):
        self.seed = seed
        sized = _keyed(docs.select("doc_id", "source", "text"), seed).select("doc_id", "source", "mix_src", "mix_key", word_count(F.col("text")).alias("size"))
        same = ["mix_src", "mix_key", "doc_id", "source", "size"]
        groups = cut_lineage(sized.groupBy(*same).agg(F.count(F.lit(1)).alias("copies")), "mix-groups")
        real = F.when(F.col("size") > 0, F.col("copies")).otherwise(0)
        words = F.col("size") * F.col("copies")
        by_source = groups.groupBy("mix_src").agg(F.first("source").alias("source"), F.sum(words).alias("source_size"), F.sum(real).alias("docs"), F.count(F.lit(1)).alias("groups"))
        by_source = cut_lineage(by_source, "mix-by-source")
        sources = source_targets(by_source).join(by_source.select("mix_src", "groups"), "mix_src")
        digits = F.ceil(F.log(16.0, F.greatest(F.col("groups") / ROWS_PER_BUCKET, F.lit(1.0)))).cast("int")
        self.sources = cut_lineage(sources.withColumn("digits", digits).drop("groups"), "mix-sources")
        placed = groups.join(self.sources, "mix_src").withColumn("bucket", F.substring("mix_key", F.lit(1), F.col("digits")))
        buckets = cut_lineage(placed.groupBy("mix_src", "bucket").agg(F.sum(words).alias("words"), F.sum(real).alias("real")), "mix-buckets")
        ahead = Window.partitionBy("mix_src").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
        starts = cut_lineage(buckets.select("mix_src", "bucket", F.coalesce(F.sum("words").over(ahead), F.lit(0)).alias("words_ahead"),
                                            F.coalesce(F.sum("real").over(ahead), F.lit(0)).alias("docs_ahead")), "mix-starts")
        here = Window.partitionBy("mix_src", "bucket").orderBy("mix_key", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
        ranked = placed.withColumns({"words_here": F.coalesce(F.sum(words).over(here), F.lit(0)), "docs_here": F.coalesce(F.sum(real).over(here), F.lit(0))})
        ranked = ranked.join(starts, ["mix_src", "bucket"])
        # copies of the cut pass: those whose end, or their middle at least, lies within what the target leaves
        left = F.col("rest") - F.col("words_ahead") - F.col("words_here")
        cut = F.when((F.col("size") > 0) & (left > 0), F.least(F.col("copies"), F.floor((2 * left + F.col("size")) / (2 * F.col("size"))))).otherwise(0)
        self.groups = cut_lineage(ranked.select(*same, "copies", "place", "docs", "source_size", "target", "passes", (F.col("docs_ahead") + F.col("docs_here")).alias("rank"),
                                                cut.cast("bigint").alias("cut")), "mix-ranked")
        taken = self.groups.groupBy("mix_src").agg(F.sum("cut").alias("cut"), F.sum(F.col("size") * (F.col("passes") * F.col("copies") + F.col("cut"))).alias("source_taken"))
        self.quotas = cut_lineage(self.sources.join(taken, "mix_src").select(
            "mix_src", "place", (F.col("passes") * F.col("docs") + F.col("cut")).alias("blocks"), "source_taken"), "mix-quotas")
        blocks, sources = self.quotas.agg(F.sum("blocks"), F.count(F.lit(1))).first()
        self.depth = max(0, math.ceil(math.log2(max(1, (blocks or 0) / blocks_per_shard))))
        shards = cut_lineage(split_quotas(self.quotas.select("place", "blocks"), self.depth, seed, sources), "mix-tree")
        self.ranges = self._ranges(shards, blocks or 0)

    def _ranges(self, shards: DataFrame, blocks: int) -> DataFrame:
        """(mix_src, cell, shard, begin, end): the range of a source's blocks that each shard drew, once for every cell of indices that it meets. A
        source has about as many cells as shards."""
        ahead = F.sum("blocks").over(Window.partitionBy("place").orderBy("shard")) - F.col("blocks")
        rows = shards.withColumn("begin", ahead).withColumn("end", F.col("begin") + F.col("blocks")).drop("blocks").join(self.quotas, "place")
        first, last = F.floor(F.col("begin") / self._width()), F.floor((F.col("end") - 1) / self._width())
        return cut_lineage(rows.select("mix_src", F.explode(F.sequence(first.cast("bigint"), last.cast("bigint"))).alias("cell"), "shard", "begin", "end"), "mix-ranges")

    def _width(self) -> Column:
        return F.greatest(F.lit(1), F.ceil(F.col("blocks") / 2 ** self.depth))

    def _drawn(self, rows: DataFrame, n: int) -> DataFrame:
        """Adds block{n}: (shard, order, words) of the shard that drew the n-th block of a copy, null if none did."""
        index = F.when(F.lit(n) < F.col("passes"), n * F.col("docs") + F.col("rank") + F.col("copy")).when(
            (F.lit(n) == F.col("passes")) & (F.col("copy") < F.col("cut")), F.col("passes") * F.col("docs") + F.col("rank") + F.col("copy"))
        rows = rows.withColumn("index", F.when(F.col("size") > 0, index)).withColumn("cell", F.floor(F.col("index") / self._width()).cast("bigint"))
        there = self.ranges.withColumnsRenamed({"mix_src": "r_src", "cell": "r_cell"})
        rows = rows.join(there, (F.col("mix_src") == F.col("r_src")) & (F.col("cell") == F.col("r_cell")) & (F.col("begin") <= F.col("index")) & (F.col("index") < F.col("end")), "left")
        order = F.xxhash64(F.lit(self.seed), F.lit("order"), F.col("mix_src"), F.col("index"))
        block = F.when(F.col("shard").isNotNull(), F.struct("shard", order.alias("order"), F.col("size").alias("words")))
        return rows.withColumn(f"block{n}", block).drop("index", "cell", "r_src", "r_cell", "shard", "begin", "end")

    def blocks_of(self) -> DataFrame:
        """A row per document: doc_id, source, size, source_size, target, source_taken, copy (among equal rows), mix_src, mix_key and blocks, the array
        (shard, order, words) of what the shards drew of it."""
        rows = self.groups.join(self.quotas.select("mix_src", "blocks", "source_taken"), "mix_src")
        many = F.col("copies") > COPIES_AT_ONCE
        few = rows.where(~many).withColumn("copy", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("copies") - 1)))
        begins = rows.where(many).withColumn("first", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("copies") - 1, F.lit(COPIES_AT_ONCE).cast("bigint"))))
        begins = begins.repartition("mix_src", "mix_key", "first")
        last = F.least(F.col("first") + COPIES_AT_ONCE, F.col("copies")) - 1
        rows = few.unionByName(begins.withColumn("copy", F.explode(F.sequence(F.col("first"), last))).drop("first"))
        for n in range(MOST):
            rows = self._drawn(rows, n)
        blocks = F.filter(F.array(*[F.col(f"block{n}") for n in range(MOST)]), lambda b: b.isNotNull())
        return rows.select("doc_id", "source", "size", "source_size", "target", "source_taken", "copy", "mix_src", "mix_key", blocks.alias("blocks"))


def taken_words(blocks: Column) -> Column:
    """Words of the blocks that shards drew."""
    return F.aggregate(blocks, F.lit(0).cast("bigint"), lambda a, b: a + b["words"])


def mix_documents(docs: DataFrame, seed: int = 4, blocks_per_shard: int = BLOCKS_PER_SHARD, with_blocks: bool = False) -> DataFrame:
    """The mix itself: a row of `docs` for every block that a shard drew, texts whole, dealt out by shard and in the shard's order. With
    `with_blocks` also `shard` and `order`.

    Rows that differ in other columns but have the id, the text and the source in common may be taken for each other.
    """
    columns = docs.columns
    blocks = MixPlan(docs, seed, blocks_per_shard).blocks_of().where(F.size("blocks") > 0)
    blocks = blocks.select("mix_src", "mix_key", "copy", F.explode("blocks").alias("b")).select("mix_src", "mix_key", "copy", F.col("b.shard").alias("mix_shard"), F.col("b.order").alias("mix_order"))
    blocks = cut_lineage(blocks, "mix-blocks")
    rows = _keyed(docs.select(*[F.col(c).alias(f"kept_{c}") for c in columns], "doc_id", "source", "text"), seed).drop("doc_id", "source", "text")
    # one row per key lends its text to all copies; only keys with copies are reduced to one
    repeated = cut_lineage(rows.groupBy("mix_src", "mix_key").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("mix_src", "mix_key"), "mix-repeated")
    if not repeated.isEmpty():
        again = rows.join(repeated, ["mix_src", "mix_key"], "left_semi").dropDuplicates(["mix_src", "mix_key"])
        rows = rows.join(repeated, ["mix_src", "mix_key"], "left_anti").unionByName(again)
    mixed = rows.join(blocks, ["mix_src", "mix_key"]).repartition("mix_shard").sortWithinPartitions("mix_shard", "mix_order", "mix_key", "copy")
    placed = [F.col("mix_shard").alias("shard"), F.col("mix_order").alias("order")] if with_blocks else []
    return mixed.select(*[F.col(f"kept_{c}").alias(c) for c in columns], *placed)
