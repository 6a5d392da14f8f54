"""Secret scans with an incremental blob ledger.

Every version of every path is addressed by the digest of its content. The ledger is a folder with two written tables: `scans`, the pairs of
blob and rule version that have been scanned, and `findings`, the spans found in them. A delivery of versions is reduced to its distinct
blobs; pairs that the ledger has are left out by an anti-join; one path per remaining blob lends its text to the scan, with the rules that
its blob lacks. A new version of one rule thus scans all blobs for that rule alone, and a delivery of known content scans nothing.
Findings are joined back to all paths by digest.

A delivery writes findings first and scans last, each into a folder of its own; a delivery that dies in between has no scans, its findings are not
read (a finding counts only with its scan), and the next one repeats it.

Hot content: copies of one text count in map-side sums and are one row in the ledger; the join back has one row per blob on one side,
so Spark can split the other.

Rules: the three base kinds, matched from left to right without overlaps and dropped afterwards if the match is too short, and further
kinds with marked prefixes, which only add spans.

Nulls and odd input: a null text is an empty one; null paths are paths; repeated rows stay; texts are scanned whole, whatever their
length; an empty table gives an empty result; other columns are not read. A missing ledger folder is an empty ledger.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..session import cut_lineage, fresh_path
from .batches import slices


@dataclass(frozen=True)
class Rule:
    """A kind of secret. Matches whose `group` has fewer than `least` characters are dropped. A changed rule takes a new version."""
    kind: str
    version: int
    pattern: str
    group: int = 0
    least: int = 1
    either_case: bool = False

    @property
    def key(self) -> str:
        return f"{self.kind}@{self.version}"

    def spans(self, text: str):
        flags = re.ASCII | (re.IGNORECASE if self.either_case else 0)
        for m in re.compile(self.pattern, flags).finditer(text):
            if m.end(self.group) - m.start(self.group) >= self.least:
                yield m.start(), m.end()


#: Where a kind is a whole run of characters, too short a run fails as a whole, so its least length stands in the pattern already.
BASE = [
    Rule("assign", 1, r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6, True),
    Rule("access", 1, r"AKIA[A-Z0-9]{16,}", 0, 20),
    Rule("hex", 1, r"[0-9a-f]{24,}", 0, 24),
]
#: Secrets with a marked beginning.
MARKED = [
    Rule("pem", 1, r"-----BEGIN (?:[A-Z0-9]+ )*PRIVATE KEY-----"),
    Rule("jwt", 1, r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{16,}"),
    Rule("github", 1, r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", 1, r"xox[abprs]-[A-Za-z0-9-]{20,}"),
    Rule("login", 1, r"://[A-Za-z0-9_.%+-]{1,64}:[A-Za-z0-9_.%+!$*-]{6,64}@[A-Za-z0-9.-]+"),
]
RULES = BASE + MARKED


class BlobLedger:
    """Scans and findings in a shared folder."""

    SCANS = "blob string, rule string"
    FINDINGS = "blob string, rule string, kind string, start bigint, end bigint"

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def _table(self, name: str, schema: str) -> DataFrame:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}")
        there = path.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(path)
        return self.spark.read.schema(schema).parquet(f"{self.folder}/{name}") if there else self.spark.createDataFrame([], schema)

    def scans(self) -> DataFrame:
        return self._table("scans", self.SCANS)

    def unseen(self, blobs: DataFrame, rules: list[Rule]) -> DataFrame:
        """(blob, rules): the rules that each of the blobs has not been scanned with; blobs without such are left out. Blobs are distinct."""
        keys = F.array(*[F.lit(r.key) for r in rules])
        done = self.scans().where(F.col("rule").isin([r.key for r in rules])).groupBy("blob").agg(F.collect_set("rule").alias("done"))
        left = blobs.join(done, "blob", "left").withColumn("rules", F.array_except(keys, F.coalesce("done", F.array().cast("array<string>"))))
        return left.where(F.size("rules") > 0).drop("done")

    def record(self, versions: DataFrame, rules: list[Rule] = RULES, path_col: str = "path") -> DataFrame:
        """Take in versions (path_col, blob, text): scan the pairs of blob and rule that are new. Returns what was scanned, (blob, rules)."""
        first = F.struct(F.col(path_col).isNull().alias("none"), F.col(path_col).alias("path"))
        blobs = versions.groupBy("blob").agg(F.min(first).alias("first"))
        todo = self.unseen(blobs, rules).select(F.col("blob").alias("__blob"), F.col("first.path").alias("__path"), "rules")
        todo = cut_lineage(todo, "ledger-todo")
        texts = versions.join(todo, (F.col("blob") == F.col("__blob")) & F.col(path_col).eqNullSafe(F.col("__path"))).select("blob", "text", "rules")
        found = texts.mapInArrow(_scan({r.key: r for r in rules}), self.FINDINGS).distinct()  # equal rows of one path lend the same text twice
        found.write.mode("append").parquet(f"{self.folder}/findings")
        todo.select(F.col("__blob").alias("blob"), F.explode("rules").alias("rule")).write.mode("append").parquet(f"{self.folder}/scans")
        return todo.select(F.col("__blob").alias("blob"), "rules")

    def findings(self, rules: list[Rule] = RULES) -> DataFrame:
        """(blob, spans): what the given rule versions found, an array of (kind, start, end) by start, then in the order of the rules."""
        place = F.create_map(*[x for i, r in enumerate(rules) for x in (F.lit(r.key), F.lit(i))])
        found = self._table("findings", self.FINDINGS).where(F.col("rule").isin([r.key for r in rules])).distinct()
        found = found.join(self.scans().distinct(), ["blob", "rule"], "left_semi")
        one = F.struct("start", place[F.col("rule")].alias("place"), "end", "kind")
        return found.groupBy("blob").agg(F.sort_array(F.collect_list(one)).alias("spans"))


def _scan(rules: dict[str, Rule]):
    def run(batches):
        for batch in slices(batches, 64):
            out = ([], [], [], [], [])
            for blob, text, keys in zip(*(batch.column(i).to_pylist() for i in range(3))):
                for key in keys:
                    for start, end in rules[key].spans(text):
                        for column, value in zip(out, (blob, key, rules[key].kind, start, end)):
                            column.append(value)
            if out[0]:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.string() if i < 3 else pa.int64()) for i, c in enumerate(out)],
                                                 ["blob", "rule", "kind", "start", "end"])
    return run


def versions_of(docs: DataFrame, path_col: str = "doc_id") -> DataFrame:
    """(path, blob, text) of documents; the blob is the digest of the text's bytes."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(F.col(path_col).alias("path"), F.sha2(text.cast("binary"), 256).alias("blob"), text.alias("text"))


def scan_documents(docs: DataFrame, folder: str | None = None, rules: list[Rule] = RULES) -> DataFrame:
    """(path, blob, spans) for every document, from the ledger in `folder` (a new one if none) after it has taken them in."""
    ledger = BlobLedger(docs.sparkSession, folder or fresh_path(docs.sparkSession, "ledger"))
    versions = versions_of(docs)
    ledger.record(versions, rules)
    found = cut_lineage(ledger.findings(rules), "ledger-findings")
    return versions.drop("text").join(found, "blob", "left").select("path", "blob", F.coalesce("spans", F.array().cast(found.schema["spans"].dataType)).alias("spans"))


def joined(spans):
    """`kind:start:end`, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
