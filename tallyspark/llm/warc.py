"""WARC archives: writing them as whole-file gzip streams, normalising those to one gzip member per record, reading by an offset index.

`write_archives` lets Spark's text writer make the archives: a row is a record without its closing blank lines, which are the line
separator, and the file is one gzip stream. `normalise` inflates each stream once, piece by piece, cuts it into records by their
Content-Length, compresses every record as its own member and writes (a) chunks of members, whose concatenation in order is the
normalised .warc.gz byte for byte, and (b) the sidecar index: archive, chunk, offset in the archive, length, record id, type, page id.
Chunks are rows because Spark's writers have no raw binary format. Pages are written in classes of size, each class with as many
records to an archive as `ARCHIVE_BYTES` has room for the class's largest, so an archive is bounded in bytes (one record at least),
and memory by one compressed archive plus one record and one chunk. Records are read back by the sidecar: its offsets and lengths name the
members, each inflated on its own.

Records of equal payloads: the one with the largest page_id is the response, the others are revisits that name it. Rows that repeat the
largest page_id are responses too, as they can't be told apart. A null html is an empty payload; a null page_id is smaller than any other
and stays null; a null url leaves out the target header; control characters and blanks in a url are percent-encoded; an empty table
makes an empty archive; other columns are not read.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..session import cut_lineage, fresh_path

BREAK = "\r\n"
RECORD_END = b"\r\n\r\n"
#: Bytes of an archive's records before compression, without headers.
ARCHIVE_BYTES = 256 << 20
#: Largest payloads of the classes; each is sixteen times the one before.
CLASS_BYTES = [1 << bits for bits in range(16, 33, 4)]
CHUNK_BYTES = 4 << 20
PIECE_BYTES = 1 << 20
LEVEL = 6
GZIP = 31  # zlib's window bits for a gzip frame
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2001-12-31T00:00:00Z"
CHUNKS = ("archive string, chunk int, start bigint, content binary, "
          "entries array<struct<offset:bigint,length:int,record_id:string,record_type:string,page_id:bigint>>")
RECORDS = "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint, target string"


def base32_sha1(data: Column) -> Column:
    """SHA-1 in base 32, from the hexadecimal form, ten digits at a time."""
    hexed = F.sha1(data)
    eights = [F.lpad(F.conv(F.substring(hexed, i, 10), 16, 32), 8, "0") for i in (1, 11, 21, 31)]
    return F.translate(F.concat(*eights), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def _safe(url: Column) -> Column:
    for c in ("%0D", "\r"), ("%0A", "\n"), ("%20", " "), ("%09", "\t"), ("%00", "\0"):
        url = F.replace(url, F.lit(c[1]), F.lit(c[0]))
    return url


def _urn(page_id: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), F.coalesce(page_id.cast("string"), F.lit("null")), F.lit(">"))


def with_record_types(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """(page_id, url, html, bytes, digest, refers_to, record_type): payloads below `least_bytes` are never revisits.

    Only digests that occur under several page ids are joined back, so most html is not shuffled for more than that; the join reads two
    plain scans, whose skewed partitions Spark splits at run time.
    """
    html = F.coalesce("html", F.lit(""))
    rows = pages.select("page_id", "url", html.alias("html"), F.octet_length(html).cast("bigint").alias("bytes"), base32_sha1(html).alias("digest"))
    shared = rows.where(F.col("bytes") >= least_bytes).groupBy("digest", "bytes").agg(
        F.max("page_id").alias("last_page"), F.min("page_id").alias("first_page"), F.count("page_id").alias("named"), F.count(F.lit(1)).alias("n"))
    shared = shared.where("n > 1 and (first_page <> last_page or (named < n and named > 0))").select("digest", "bytes", "last_page")
    joined = rows.join(cut_lineage(shared, "warc-shared"), ["digest", "bytes"], "left")
    revisit = F.col("last_page").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("last_page"))
    return joined.select("page_id", "url", "html", "bytes", "digest", F.when(revisit, F.col("last_page")).alias("refers_to"),
                         F.when(revisit, F.lit("revisit")).otherwise(F.lit("response")).alias("record_type"))


def record_text(rows: DataFrame) -> DataFrame:
    """(value): a WARC record without its two closing line breaks."""
    revisit = F.col("record_type") == "revisit"
    http = F.concat(F.lit(BREAK.join(["HTTP/1.1 200 OK", "Content-Type: text/html; charset=utf-8", "Content-Length: "])), F.col("bytes").cast("string"),
                    F.lit(BREAK * 2))
    block_bytes = F.octet_length(http) + F.when(revisit, 0).otherwise(F.col("bytes"))

    def line(name, value):
        return F.concat(F.lit(f"{name}: "), value, F.lit(BREAK))

    head = F.concat(
        F.lit("WARC/1.1" + BREAK), line("WARC-Type", F.col("record_type")), line("WARC-Record-ID", _urn(F.col("page_id"))),
        line("WARC-Date", F.lit(DATE)), F.coalesce(line("WARC-Target-URI", _safe(F.col("url"))), F.lit("")),
        line("Content-Type", F.lit("application/http; msgtype=response")), line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
        F.when(revisit, F.concat(line("WARC-Profile", F.lit(PROFILE)), line("WARC-Refers-To", _urn(F.col("refers_to"))))).otherwise(F.lit("")),
        line("Content-Length", block_bytes.cast("string")), F.lit(BREAK))
    return rows.select(F.concat(head, http, F.when(revisit, F.lit("")).otherwise(F.col("html"))).alias("value"))


def write_archives(pages: DataFrame, path: str, archive_bytes: int = ARCHIVE_BYTES, least_bytes: int = 0) -> str:
    """Writes the pages as WARC files in folders below `path`, one for each class of sizes; each file is one gzip stream."""
    typed = with_record_types(pages, least_bytes)
    size = F.coalesce(F.octet_length("html"), F.lit(0))
    of = F.lit(0)
    for i, least in enumerate(CLASS_BYTES):
        of = F.when(size > least, i + 1).otherwise(of)
    there = sorted(r[0] for r in pages.select(of.alias("c")).distinct().collect()) or [0]  # one number per class
    for c in there:
        most = CLASS_BYTES[c] if c < len(CLASS_BYTES) else archive_bytes
        writer = record_text(typed.where(of == c)).write.option("lineSep", RECORD_END.decode()).option("compression", "gzip")
        writer.option("maxRecordsPerFile", max(1, archive_bytes // most)).text(f"{path}/class-{c}")
    return path


def headers(block: bytes) -> tuple[dict[str, str], int]:
    """Header fields in lower case, and where the content begins."""
    end = block.index(RECORD_END)
    fields = (line.split(b":", 1) for line in bytes(block[:end]).split(b"\r\n")[1:])
    return {k.strip().lower().decode(): v.strip().decode() for k, v in fields}, end + len(RECORD_END)


def inflated(data: bytes) -> Iterator[bytes]:
    """The stream's bytes in pieces; several members in a row are read on."""
    todo = data
    while todo:
        stream = zlib.decompressobj(GZIP)
        while todo and not stream.eof:
            if piece := stream.decompress(todo, PIECE_BYTES):
                yield piece
            todo = stream.unconsumed_tail
        todo = stream.unused_data if stream.eof else b""


def records(pieces: Iterator[bytes]) -> Iterator[bytes]:
    """Whole records, closing line breaks included, cut by Content-Length."""
    held, need = bytearray(), 0
    for piece in pieces:
        held += piece
        at = 0
        while True:
            if not need:
                end = held.find(RECORD_END, at)
                if end < 0:
                    break
                fields, begin = headers(held[at:end + len(RECORD_END)])
                need = begin + int(fields["content-length"]) + len(RECORD_END)
            if len(held) - at < need:
                break
            yield bytes(held[at:at + need])
            at, need = at + need, 0
        del held[:at]
    if held.strip():
        raise ValueError("an archive ends within a record")


def member(record: bytes, level: int = LEVEL) -> bytes:
    packer = zlib.compressobj(level, zlib.DEFLATED, GZIP)
    return packer.compress(record) + packer.flush()


def _page(urn: str | None) -> int | None:
    name = (urn or "").strip("<>").rpartition(":")[2]
    return None if name in ("", "null") else int(name)


def _normalised(level: int, chunk_bytes: int):
    def run(batches):
        for batch in batches:
            for path, data in zip(batch["path"], batch["content"]):
                chunk, start, content, entries = 0, 0, [], []
                offset, size = 0, 0
                for record in records(inflated(data)):
                    fields, _ = headers(record)
                    packed = member(record, level)
                    entries.append({"offset": offset, "length": len(packed), "record_id": fields["warc-record-id"], "record_type": fields["warc-type"],
                                    "page_id": _page(fields["warc-record-id"])})
                    content.append(packed)
                    offset, size = offset + len(packed), size + len(packed)
                    if size >= chunk_bytes:
                        yield pd.DataFrame({"archive": [path], "chunk": [chunk], "start": [start], "content": [b"".join(content)], "entries": [entries]})
                        chunk, start, content, entries, size = chunk + 1, offset, [], [], 0
                if content:
                    yield pd.DataFrame({"archive": [path], "chunk": [chunk], "start": [start], "content": [b"".join(content)], "entries": [entries]})
    return run


def normalise(spark: SparkSession, archives: str, out: str, level: int = LEVEL, chunk_bytes: int = CHUNK_BYTES) -> tuple[DataFrame, DataFrame]:
    """Rewrites the archives below `archives` as members; returns (chunks, index), both written below `out`."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").option("recursiveFileLookup", True).load(archives).select(
        F.substring_index("path", "/", -1).alias("path"), "content")
    files.mapInPandas(_normalised(level, chunk_bytes), CHUNKS).write.option("compression", "none").parquet(f"{out}/chunks")
    chunks = spark.read.parquet(f"{out}/chunks")
    entries = chunks.select("archive", "chunk", "start", F.explode("entries").alias("e")).select("archive", "chunk", "start", "e.*")
    entries.write.parquet(f"{out}/index")
    return chunks, spark.read.parquet(f"{out}/index")


def _parsed(packed: bytes) -> tuple:
    record = zlib.decompress(packed, GZIP)
    fields, begin = headers(record)
    http, body = headers(record[begin:begin + int(fields["content-length"])])
    refers = _page(fields.get("warc-refers-to"))
    if fields["warc-type"] == "revisit":
        digest, size = fields["warc-payload-digest"].partition(":")[2], int(http["content-length"])
    else:
        payload = record[begin + body:begin + int(fields["content-length"])]
        digest, size = base64.b32encode(hashlib.sha1(payload).digest()).decode(), len(payload)
    return _page(fields["warc-record-id"]), size, digest, fields["warc-type"], refers, fields.get("warc-target-uri")


def read_records(chunks: DataFrame, index: DataFrame | None = None) -> DataFrame:
    """The records that `index` names (any part of the sidecar; without it all), each inflated on its own from its offset.

    A response's digest and length are those of the payload that is there; a revisit has those of the payload that it stands for.
    """
    if index is None:
        rows = chunks.select("content", F.transform("entries", lambda e: F.struct((e["offset"] - F.col("start")).alias("at"), e["length"].alias("length"))).alias("wanted"))
    else:
        wanted = index.groupBy("archive", "chunk").agg(F.collect_list(F.struct((F.col("offset") - F.col("start")).alias("at"), "length")).alias("wanted"))
        rows = chunks.select("archive", "chunk", "content").join(wanted, ["archive", "chunk"])

    def run(batches):
        for batch in batches:
            for content, places in zip(batch["content"], batch["wanted"]):
                found = [_parsed(content[p["at"]:p["at"] + p["length"]]) for p in places]
                yield pd.DataFrame(found, columns=["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "target"]).astype(
                    {"page_id": "Int64", "refers_to": "Int64", "target": object})

    return rows.mapInPandas(run, RECORDS)


def warc_round_trip(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """Writes the pages, normalises the archives and reads every record back by the sidecar index."""
    spark = pages.sparkSession
    root = fresh_path(spark, "warc")
    chunks, index = normalise(spark, write_archives(pages, f"{root}/streams", least_bytes=least_bytes), f"{root}/members")
    return read_records(chunks, index)
