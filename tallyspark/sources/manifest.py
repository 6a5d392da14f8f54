"""File manifest: one row per landed file, duplicates, size checks, retention classes."""

import hashlib
import re
from collections.abc import Callable, Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

MIN_BYTES = 1024
#: A file is read in pieces of so many bytes, whatever its size.
PIECE = 8 << 20


def scan_files(spark: SparkSession, path: str, pattern: str = "part-*") -> DataFrame:
    """Files below a folder. Spark's scans pass over empty files, so these come from the names that Spark has listed, without a time."""
    files = spark.read.format("binaryFile").options(recursiveFileLookup=True, pathGlobFilter=pattern).load(path)
    listed = spark.createDataFrame([(re.sub("^file:/+", "file:/", unquote(name)),) for name in files.inputFiles()], "path string")
    empty = listed.join(files.select("path"), "path", "left_anti").select(
        "path", F.lit(None).cast("timestamp").alias("modificationTime"), F.lit(0).cast("bigint").alias("length"), F.lit(b"").alias("content"))
    return files.unionByName(empty)


def open_file(path: str):
    """A stream of the bytes behind an address as Spark lists it."""
    scheme, _, rest = path.partition(":")
    if scheme == "file":
        return fs.LocalFileSystem().open_input_stream("/" + rest.lstrip("/"))
    scheme = {"s3a": "s3", "s3n": "s3", "abfss": "abfs"}.get(scheme, scheme)
    system, name = fs.FileSystem.from_uri(f"{scheme}:{quote(rest, safe='/:@')}")
    return system.open_input_stream(name)


def with_digest(files: DataFrame, opener: Callable = open_file, piece: int = PIECE) -> DataFrame:
    """(path, length, content_hash): the SHA-256 of each file, read where the file is listed.

    A task holds one piece of one file, so files may be of any size. A digest runs through its file in order: one file is one task's
    work, different files are spread by size. `opener` is for addresses of other file systems.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes = []
            for path in batch.column(0).to_pylist():
                digest = hashlib.sha256()
                with opener(path) as stream:
                    while part := stream.read(piece):
                        digest.update(part)
                hashes.append(digest.hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(hashes, pa.string())], names=["path", "length", "content_hash"])

    return files.select("path", "length").mapInArrow(run, "path string, length bigint, content_hash string")


def manifest(files: DataFrame, opener: Callable = open_file, piece: int = PIECE) -> DataFrame:
    """Size, content hash, format and period of each file."""
    name = F.element_at(F.split("path", "/"), -1)
    return with_digest(files, opener, piece).select(
        "path", name.alias("file_name"), F.col("length").alias("file_bytes"), "content_hash",
        F.upper(F.regexp_extract(name, r"\.([a-z]+)$", 1)).alias("file_format"),
        F.concat(F.regexp_extract("path", r"year=(\d{4})", 1), F.regexp_extract("path", r"month=(\d{1,2})", 1)).alias("period_detected"),
        F.when(F.col("length") > 0, "RECEIVED").otherwise("EMPTY").alias("status"))


def mark_duplicates(manifest_rows: DataFrame, key: str = "content_hash", order: str = "received_at", ident: str = "file_id") -> DataFrame:
    """Later arrivals of a content hash point to the first one. The first arrival is an aggregate, so a hash with very many
    copies is combined before the shuffle and joined back as one row."""
    first = manifest_rows.groupBy(key).agg(F.min(F.struct(F.col(order), F.col(ident))).alias("_f"))
    return manifest_rows.join(first, key).select(
        *[manifest_rows[c] for c in manifest_rows.columns],
        F.when(F.col(ident) == F.col(f"_f.{ident}"), "NEW").otherwise("DUPLICATE").alias("status"),
        F.when(F.col(ident) != F.col(f"_f.{ident}"), F.col(f"_f.{ident}")).alias("duplicate_of"))


def landing_check(files: DataFrame, min_bytes: int = MIN_BYTES) -> DataFrame:
    """Are files there, and is each at least the smallest plausible size? Reads no content."""
    small = F.count(F.when(F.col("length") < min_bytes, 1))
    return files.select("length").agg(
        F.count("*").alias("files"), F.sum("length").alias("bytes"), F.min("length").alias("smallest"), small.alias("too_small"),
        F.when(F.count("*") == 0, "MISSING").when(small > 0, "TOO_SMALL").otherwise("OK").alias("status"))


def retention_tier(created: str, as_of: str) -> Column:
    age = F.date_diff(F.to_date(F.lit(as_of)), F.col(created))
    return F.when(age < 90, "HOT").when(age < 730, "COOL").when(age < 2922, "ARCHIVE").when(age < 3650, "RELEASED").otherwise("DELETE")
