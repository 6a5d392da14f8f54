"""Merkle manifest of a dataset with octopus multiproofs.

Leaves are digests of rows. Within a source they stand in the order of ids, and runs of `FAN` nodes become one node until one is left, the
source's subroot; the subroots, in the order of sources, become the root the same way. Digests go into hashes as hex text.

Building: leaves are numbered by a range sort (counts per range are added up, no window over rows) and dealt out in units of
FAN ** `LEVELS` consecutive leaves of a source; many units share a block. A unit's nodes of the next LEVELS levels are made in one task,
then the units' tops are the leaves of the next round. All nodes are kept in a written table, which is the manifest.

Proving: every leaf partition (a block of units, with the leaves to be proven in it) goes up its trees once with coordinates only: where a
sibling is neither among its leaves nor above them, the coordinate is missing. The union of these, each once, is fetched with one join
for all partitions. The partition then derives the interiors that its leaves share from the leaves and the fetched nodes, and writes out every leaf's own
proof. A leaf that is claimed to be another (tampered) is folded on its own. What lies above the subroots is proven once per source in
the same way, and handed to the source's blocks.

Hot nodes: a node high up in a large source's tree is asked for by many blocks. Level and block size bound how many, so node and
requests carry a salt by that rule; subroot paths are copied per `ASKERS` units of their source.

Nulls and odd input: a null field is `-`; ids and sources may be null (ids first, sources first); rows with equal source and id stand in the order
of their digests, equal ones side by side; a source of one leaf has the leaf as its subroot, with an empty proof below; an empty table
gives an empty result and no root; texts of any length are hashed whole; other columns are not read.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.types import BinaryType, StructField, StructType

from ..session import cut_lineage

FAN = 3
LEVELS = 7
BLOCK_LEAVES = 4096
ASKERS = 4096
FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]
NODE = "tree bigint, n bigint, level int, idx bigint, digest binary"


def leaf_of(columns) -> "F.Column":
    """Digest (32 bytes) of fields: `-` if null, else the byte count, a colon and the value."""
    texts = [F.col(c).cast("string") if isinstance(c, str) else c.cast("string") for c in columns]
    parts = [F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]
    return F.unhex(F.sha2(F.concat(*parts).cast("binary"), 256))


def height(n: int) -> int:
    levels = 0
    while FAN ** levels < n:
        levels += 1
    return levels


def parent(digests: list[bytes]) -> bytes:
    return hashlib.sha256("".join(d.hex() for d in digests).encode()).digest()


def count_at(n: int, level: int) -> int:
    """Nodes of a tree of n leaves at a level."""
    return -(-n // FAN ** level)


def numbered(rows: DataFrame, tree: list[str], order: list[str]) -> DataFrame:
    """`rows` with __place (from 0) in the order of `order` within equal `tree` columns, and __n, the rows of the tree.

    One range sort; the rest are counts per range and tree. A written counter of rows makes equal rows separable, so that ranges can be cut
    anywhere. Nulls come first, text bytewise.
    """
    spark = rows.sparkSession
    rows = cut_lineage(rows.withColumn("__nth", F.monotonically_increasing_id()), "merkle-rows")
    keys = [F.col(c).asc_nulls_first() for c in [*tree, *order, "__nth"]]
    ranged = rows.repartitionByRange(*keys).sortWithinPartitions(*keys).drop("__nth")
    ranged = ranged.withColumn("__range", F.spark_partition_id()).withColumn("__row", F.monotonically_increasing_id())
    ranged = cut_lineage(ranged, "merkle-sorted")
    mine = [F.col(c) for c in tree]
    counts = cut_lineage(ranged.groupBy(*mine, "__range").agg(F.count(F.lit(1)).alias("__c"), F.min("__row").alias("__first")), "merkle-counts")
    by = Window.partitionBy(*(mine or [F.lit(0)]))
    counts = counts.select(*mine, "__range", "__first", F.sum("__c").over(by).alias("__n"),
                           (F.sum("__c").over(by.orderBy("__range")) - F.col("__c")).alias("__before"))
    counts = cut_lineage(counts, "merkle-offsets").select(*[F.col(c).alias(f"__{c}") for c in tree], F.col("__range").alias("__r"), "__first", "__n", "__before")
    same = F.col("__range") == F.col("__r")
    for c in tree:
        same &= F.col(c).eqNullSafe(F.col(f"__{c}"))
    placed = ranged.join(counts, same).withColumn("__place", F.col("__row") - F.col("__first") + F.col("__before"))
    return placed.drop("__range", "__row", "__r", "__first", "__before", *[f"__{c}" for c in tree])


def blocked(rows: DataFrame, total: int, at: str = "idx") -> DataFrame:
    """`rows` (tree, at) with their unit and the block that the unit is dealt to."""
    unit = F.floor(F.col(at) / FAN ** LEVELS).cast("bigint")
    blocks = max(1, -(-total // BLOCK_LEAVES))
    return rows.withColumn("unit", unit).withColumn("block", F.pmod(F.xxhash64("tree", "unit"), F.lit(blocks)))


def _fold_units(levels: int):
    """The nodes of the next levels above units of FAN ** levels nodes."""
    def run(key, table):
        table = table.sort_by([("tree", "ascending"), ("idx", "ascending")])
        out = ([], [], [], [], [])
        units: dict = {}
        for tree, n, level, idx, digest in zip(*(table[c].to_pylist() for c in ("tree", "n", "level", "idx", "digest"))):
            units.setdefault((tree, idx // FAN ** levels), (n, level, idx, []))[3].append(digest)
        for (tree, _), (n, level, first, nodes) in units.items():
            for _ in range(min(levels, height(n) - level)):
                nodes, first, level = [parent(nodes[i:i + FAN]) for i in range(0, len(nodes), FAN)], first // FAN, level + 1
                for i, digest in enumerate(nodes):
                    for column, value in zip(out, (tree, n, level, first + i, digest)):
                        column.append(value)
        return pa.table([pa.array(c, t) for c, t in zip(out, (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.binary()))],
                        names=["tree", "n", "level", "idx", "digest"])
    return run


def built(leaves: DataFrame, total: int, largest: int) -> DataFrame:
    """All nodes (NODE) of the trees whose leaves (tree, n, idx, digest) are given; `largest` is the leaf count of the largest tree."""
    base = leaves.select("tree", "n", F.lit(0).alias("level"), "idx", "digest")
    tables, level = [base], 0
    while level < height(largest):
        top = tables[-1].where((F.col("level") == level) & (F.col("n") > FAN ** level))
        dealt = blocked(top, -(-total // FAN ** level))
        tables.append(cut_lineage(dealt.groupBy("block").applyInArrow(_fold_units(LEVELS), NODE), "merkle-nodes"))
        level += LEVELS
    out = tables[0]
    for t in tables[1:]:
        out = out.unionByName(t)
    return out


def missing(leaves: list[int], n: int) -> list[tuple[int, int]]:
    """Coordinates (level, idx) that the leaves' common proof needs and that don't lie above one of them."""
    known, out = sorted(set(leaves)), []
    for level in range(height(n)):
        have, last = set(known), count_at(n, level)
        above = sorted({i // FAN for i in known})
        out += [(level, i) for run in above for i in range(run * FAN, min(run * FAN + FAN, last)) if i not in have]
        known = above
    return out


def askers(level):
    """Salts of a node at a level: one per ASKERS units that may ask for it."""
    return F.greatest(F.lit(1), F.ceil(F.pow(F.lit(float(FAN)), level) * FAN / float(FAN ** LEVELS * ASKERS))).cast("bigint")


def _ask(key, table):
    trees: dict = {}
    for tree, n, idx in zip(*(table[c].to_pylist() for c in ("tree", "n", "idx"))):
        trees.setdefault((tree, n), []).append(idx)
    rows = [(key[0].as_py(), tree, level, idx) for (tree, n), found in trees.items() for level, idx in missing(found, n)]
    columns = list(zip(*rows)) if rows else [[], [], [], []]
    return pa.table([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.int32(), pa.int64()))], names=["block", "tree", "level", "idx"])


def _siblings(idx: int, n: int, node) -> list[bytes]:
    out = []
    for level in range(height(n)):
        run = idx // FAN * FAN
        out += [node(level, i) for i in range(run, min(run + FAN, count_at(n, level))) if i != idx]
        idx //= FAN
    return out


def folded(digest: bytes, idx: int, n: int, siblings: list[bytes]) -> bytes:
    """The top that a leaf and its siblings give."""
    at = 0
    for level in range(height(n)):
        place, others = idx % FAN, min(FAN, count_at(n, level) - idx // FAN * FAN) - 1
        run = siblings[at:at + others]
        digest = parent(run[:place] + [digest] + run[place:])
        at, idx = at + others, idx // FAN
    return digest


def _derive(leaves: dict[int, bytes], n: int, fetched) -> dict[tuple[int, int], bytes]:
    """Every node above the leaves, from them and what was fetched."""
    known = {(0, i): d for i, d in leaves.items()}
    now = sorted(leaves)
    for level in range(height(n)):
        last = count_at(n, level)
        above = sorted({i // FAN for i in now})
        for run in above:
            known[level + 1, run] = parent([known.get((level, i)) or fetched[level, i] for i in range(run * FAN, min(run * FAN + FAN, last))])
        now = above
    return known


def _expand(key, leaves, nodes):
    """Proofs of a block's leaves. `nodes` has the fetched nodes, and at level -1 what lies above each tree's top: place, count and path."""
    fetched, above = {}, {}
    for tree, level, idx, n, digest in zip(*(nodes[c].to_pylist() for c in ("tree", "level", "idx", "n", "digest"))):
        if level < 0:
            above[tree] = (idx, n, [digest[i:i + 32] for i in range(0, len(digest), 32)])
        else:
            fetched.setdefault(tree, {})[level, idx] = digest
    rows = list(zip(*(leaves[c].to_pylist() for c in ("tree", "n", "idx", "leaf", "claimed"))))
    trees: dict = {}
    for tree, n, idx, digest, _ in rows:
        trees.setdefault((tree, n), {})[idx] = digest
    known = {tree: _derive(found, n, fetched.get(tree, {})) for (tree, n), found in trees.items()}
    out, tops = ([], [], [], []), {}
    for tree, n, idx, digest, claimed in rows:
        have, got = known[tree], fetched.get(tree, {})
        place, trees_n, path = above.get(tree, (0, 1, []))
        siblings = _siblings(idx, n, lambda level, i: have.get((level, i)) or got[level, i])
        if tree not in tops:
            top = have[height(n), 0]
            tops[tree] = (top, folded(top, place, trees_n, path))
        end = tops[tree][1] if claimed is None else folded(folded(claimed, idx, n, siblings), place, trees_n, path)
        for column, value in zip(out, (b"".join(siblings), hashlib.sha256("".join(s.hex() for s in siblings + path).encode()).digest(), end, tops[tree][0])):
            column.append(value)
    for name, column in zip(PROOF, out):
        leaves = leaves.append_column(name, pa.array(column, pa.binary()))
    return leaves


PROOF = ["siblings", "proof", "folded", "top"]


def proven(leaves: DataFrame, nodes: DataFrame, total: int, above: DataFrame | None = None) -> DataFrame:
    """The leaves (tree, n, idx, leaf, claimed and what else they have; not necessarily all of a tree) with PROOF, from the trees' `nodes`.

    siblings: the path below the tree's top, 32 bytes each; proof: digest over it and what lies above; folded: where the claimed leaf (if
    null, the leaf itself) leads to; top: the tree's top as derived from leaves and fetched nodes. `above`: (tree, leaves, place, count, path) where
    the tops are leaves of a further tree.
    """
    dealt = blocked(leaves, total)
    asked = dealt.groupBy("block").applyInArrow(_ask, "block bigint, tree bigint, level int, idx bigint")
    asked = cut_lineage(asked.withColumn("salt", F.pmod(F.xxhash64("block"), askers(F.col("level")))), "merkle-asked")
    levels = [r["level"] for r in asked.select("level").distinct().collect()]  # as many as a tree has levels
    copies = lambda n: F.explode(F.sequence(F.lit(0).cast("bigint"), n - 1))
    store = nodes.where(F.col("level").isin(levels)).withColumn("salt", copies(askers(F.col("level"))))
    fetched = asked.join(store, ["tree", "level", "idx", "salt"]).select("block", "tree", "level", "idx", "n", "digest")
    if above is not None:
        many = lambda n: F.greatest(F.lit(1), F.ceil(F.col(n) / float(FAN ** LEVELS * ASKERS))).cast("bigint")
        units = dealt.groupBy("tree", "block").agg(F.first("n").alias("n")).withColumn("salt", F.pmod(F.xxhash64("block"), many("n"))).drop("n")
        paths = above.withColumn("salt", copies(many("leaves")))
        fetched = fetched.unionByName(units.join(paths, ["tree", "salt"]).select(
            "block", "tree", F.lit(-1).alias("level"), F.col("place").alias("idx"), F.col("count").alias("n"), F.col("path").alias("digest")))
    schema = StructType([*dealt.schema.fields, *[StructField(name, BinaryType()) for name in PROOF]])
    fetched = cut_lineage(fetched, "merkle-fetched")
    return dealt.groupBy("block").cogroup(fetched.groupBy("block")).applyInArrow(_expand, schema).drop("unit", "block")


class Manifest:
    """Leaves, nodes and root of a dataset. `rows`: id_col, source_col, leaf (32 bytes); more columns stay with the leaves."""

    def __init__(self, rows: DataFrame, id_col: str = "doc_id", source_col: str = "source"):
        placed = cut_lineage(numbered(rows, [source_col], [id_col, "leaf"]), "merkle-leaves")
        size = placed.agg(F.count(F.lit(1)).alias("rows"), F.max("__n").alias("largest")).first()
        self.total, largest = size["rows"], size["largest"] or 0
        sources = placed.where("__place = 0").select(F.col(source_col).alias("__s"), F.col("__n").alias("leaves"))
        sources = cut_lineage(numbered(sources, [], ["__s"]).select("__s", "leaves", F.col("__place").alias("tree"), F.col("__n").alias("__sources")), "merkle-sources")
        leaves = placed.join(sources.select("__s", "tree"), F.col(source_col).eqNullSafe(F.col("__s"))).drop("__s")
        self.leaves = cut_lineage(leaves.withColumnsRenamed({"__place": "idx", "__n": "n"}), "merkle-dealt")
        self.nodes = built(self.leaves.select("tree", "n", "idx", F.col("leaf").alias("digest")), self.total, largest)
        tops = self.nodes.where("idx = 0").groupBy("tree").agg(F.max_by("digest", "level").alias("digest"))
        self.subroots = cut_lineage(sources.join(tops, "tree").select(
            "__s", "leaves", F.lit(0).cast("bigint").alias("tree"), F.col("__sources").alias("n"), F.col("tree").alias("idx"), "digest"), "merkle-subroots")
        self.sources = sources.agg(F.count(F.lit(1))).first()[0]
        self.top_nodes = built(self.subroots, self.sources, self.sources)
        root = self.top_nodes.where(F.col("level") == height(self.sources)).select("digest").first() if self.sources else None
        self.root = bytes(root["digest"]) if root else None

    def prove(self, leaves: DataFrame | None = None) -> DataFrame:
        """Leaves (all, or some of self.leaves; where `claimed` is not null it stands in for the leaf) with PROOF, folded to the root; top is the
        subroot."""
        leaves = self.leaves if leaves is None else leaves
        nothing = F.lit(None).cast("binary").alias("claimed")
        if "claimed" not in leaves.columns:
            leaves = leaves.select("*", nothing)
        tops = proven(self.subroots.select("tree", "n", "idx", F.col("digest").alias("leaf"), "leaves", nothing), self.top_nodes, self.sources)
        above = tops.select(F.col("idx").alias("tree"), "leaves", F.col("idx").alias("place"), F.col("n").alias("count"), F.col("siblings").alias("path"))
        return proven(leaves, self.nodes, self.total, cut_lineage(above, "merkle-above"))


def proofs_of(docs: DataFrame) -> DataFrame:
    """(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified) per document; where the id's checksum is even, the claimed text lacks
    its line feeds. Digests as hex."""
    even = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    fields = [F.col(c) for c in FIELDS]
    changed = leaf_of([*fields[:-1], F.replace(F.col("text"), F.lit("\n"), F.lit(""))])
    claimed = F.when(even & F.contains(F.col("text"), F.lit("\n")), changed)
    manifest = Manifest(docs.select("doc_id", "source", leaf_of(fields).alias("leaf"), claimed.alias("claimed")))
    hexed = lambda c: F.lower(F.hex(c))
    root = F.lit(manifest.root.hex() if manifest.root else None).cast("string")
    found = manifest.prove().select("doc_id", "leaf", "top", "proof", "folded")
    return found.select("doc_id", hexed("leaf").alias("leaf"), hexed("top").alias("subroot"), root.alias("root"), hexed("proof").alias("proof_sha256"),
                        hexed("folded").alias("folded_root"), (hexed("folded") == root).alias("verified"))
