"""WARC archives as tables of chunked records.

A page becomes one WARC record. A payload beyond the chunk size becomes several: a first
segment and continuation records, which are rows (record, segment number, chunk), so no row is
larger than a chunk. Records go to files through Spark's text writer with the record end
as line separator: the content of the part files is plain WARC/1.1, gzip-compressed.

Reading splits the files at the version line that begins each record. Chunks are cut so
that none holds that version string, which makes the split safe for any payload. Whole
records are digested in the JVM; the segments of long ones are sorted by record and
number and streamed through one incremental digest, never joined.
"""

from __future__ import annotations

import hashlib
import os
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sunset_engine.llm.common import table
from sunset_engine.operators.joins import materialize
from sunset_engine.session import scratch_path

VERSION = "WARC/1.1"
END = "\r\n\r\n"
# Characters of a chunk; up to four bytes each.
CHUNK_CHARS = 1 << 16
# Payloads of fewer bytes are stored again rather than referred to.
REVISIT_BYTES = 100


def chunks(payload: Column, size: int) -> Column:
    """The payload as an array of chunks of at most ``size`` characters, none holding the version string."""
    def cut(part: Column) -> Column:
        return F.transform(F.sequence(F.lit(1), F.greatest(F.length(part), F.lit(1)), F.lit(size)), lambda i: F.substring(part, i, F.lit(size)))

    half = len(VERSION) // 2
    pieces = F.split(payload, VERSION.replace(".", r"\."), -1)
    last = F.size(pieces) - 1
    joined = F.transform(pieces, lambda p, i: F.concat(F.when(i > 0, VERSION[half:]).otherwise(""), p, F.when(i < last, VERSION[:half]).otherwise("")))
    whole = (F.length(payload) <= size) & (F.instr(payload, VERSION) == 0)
    return F.when(whole, F.array(payload)).otherwise(F.flatten(F.transform(joined, cut)))


def _header(name: str, value: Column) -> Column:
    """A header line, or nothing for a null value."""
    return F.coalesce(F.concat(F.lit(f"\r\n{name}: "), value.cast("string")), F.lit(""))


def records(pages: DataFrame, id_col: str, url_col: str, payload_col: str, chunk_chars: int, date: str) -> DataFrame:
    """One row (value) per WARC record, without its end."""
    base = (pages.select(F.col(id_col).cast("long").alias("id"), F.col(url_col).cast("string").alias("url"), F.coalesce(F.col(payload_col).cast("string"), F.lit("")).alias("payload"))
            .withColumn("digest", F.sha2(F.col("payload").cast("binary"), 256)).withColumn("bytes", F.octet_length("payload")))
    # Only payloads that occur again. Written first, so that Spark knows their size: it broadcasts a small
    # table and does not move the pages, and joins by digest otherwise.
    again = materialize(base.where(f"bytes >= {REVISIT_BYTES}").groupBy("digest").agg(F.min("id").alias("first"), F.count("*").alias("copies"))
                        .where("copies > 1").select("digest", "first"), "warc-again")
    known = base.join(again, "digest", "left").withColumn("revisit", F.coalesce(~F.col("first").eqNullSafe(F.col("id")) & F.col("first").isNotNull(), F.lit(False)))
    cut = (known.withColumn("copy", F.uuid())
           .withColumn("chunks", F.when(F.col("revisit"), F.array(F.lit(""))).otherwise(chunks(F.col("payload"), chunk_chars)))
           .drop("payload").withColumn("parts", F.size("chunks"))
           .select("*", F.posexplode("chunks").alias("at", "chunk")).drop("chunks"))
    many, first = F.col("parts") > 1, F.col("at") == 0
    kind = F.when(F.col("revisit"), "revisit").when(first, "response").otherwise("continuation")
    name = F.concat(F.lit("<urn:page:"), F.coalesce(F.col("id").cast("string"), F.lit("")), F.when(first, "").otherwise(F.concat(F.lit(":"), F.col("at") + 1)), F.lit(">"))
    origin = F.concat(F.lit("<urn:page:"), F.coalesce(F.col("id").cast("string"), F.lit("")), F.lit(">"))
    uri = F.replace(F.regexp_replace("url", r"[\x00-\x20\x7F]", "%20"), F.lit(VERSION), F.lit(VERSION.replace("/", "%2F")))
    head = F.concat(
        F.lit(VERSION), _header("WARC-Type", kind), _header("WARC-Record-ID", name), _header("WARC-Date", F.lit(date)),
        _header("WARC-Target-URI", uri), _header("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("digest"))),
        _header("WARC-Payload-Length", F.col("bytes")),
        _header("WARC-Refers-To", F.when(F.col("revisit"), F.concat(F.lit("<urn:page:"), F.col("first"), F.lit(">")))),
        _header("WARC-Profile", F.when(F.col("revisit"), "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")),
        _header("WARC-Segment-Number", F.when(many, F.col("at") + 1)), _header("WARC-Segment-Origin-ID", F.when(~first, origin)),
        _header("WARC-Segment-Total-Length", F.when(many & (F.col("at") == F.col("parts") - 1), F.col("bytes"))),
        _header("WARC-Copy", F.col("copy")),
        _header("Content-Type", F.lit("text/html; charset=utf-8")), _header("Content-Length", F.octet_length("chunk")))
    return cut.select(F.concat(head, F.lit(END), F.col("chunk")).alias("value"))


def write_warc(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html",
               chunk_chars: int = CHUNK_CHARS, date: str = "2024-01-01T00:00:00Z") -> None:
    """Write one record per row of ``pages`` under ``path``.

    A null payload is empty. Of rows with equal payloads of at least 100 bytes, the one with the
    smallest id is a response (all rows that repeat that id are) and the others revisit it; all
    other rows are responses. A row without an id keeps its record, but is never revisited.
    Other columns are not read; an empty table writes no record.
    """
    records(pages, id_col, url_col, payload_col, chunk_chars, date).write.mode("errorifexists").option("lineSep", END).option("compression", "gzip").text(path)


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """One row per record of the archives: (type, page_id, copy, refers_to, digest, bytes, segment, chunk).

    ``segment`` is null for a record of one part; ``digest`` and ``bytes`` are what the header
    says of the whole payload. A record whose length differs from its header fails the read.
    """
    raw = spark.read.option("lineSep", VERSION + "\r\n").text(path).where("value <> ''")
    head = F.substring_index("value", END, 1)
    parsed = raw.withColumn("head", F.concat(F.lit("\r\n"), head)).select(
        "head", F.expr(f"substring(value, length(head) + {len(END) - 1}, length(value) - length(head) - {2 * len(END) - 2})").alias("chunk"))
    field = lambda name: F.regexp_extract("head", rf"\r\n{name}: ([^\r]*)", 1)
    some = lambda c: F.when(c != "", c)
    page = lambda c: some(F.regexp_extract(c, r"^<urn:page:(-?\d+)", 1)).cast("long")
    good = F.octet_length("chunk") == field("Content-Length").try_cast("long")
    return parsed.select(
        field("WARC-Type").alias("type"), page(field("WARC-Record-ID")).alias("page_id"), field("WARC-Copy").alias("copy"),
        page(field("WARC-Refers-To")).alias("refers_to"), F.regexp_extract(field("WARC-Payload-Digest"), r"^sha256:(.*)$", 1).alias("digest"),
        field("WARC-Payload-Length").try_cast("long").alias("bytes"), field("WARC-Segment-Number").try_cast("int").alias("segment"),
        F.when(good, F.col("chunk")).otherwise(F.raise_error(F.lit("a WARC record is cut short"))).alias("chunk"))


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Segments sorted by record and number to one row per record; the open record's digest is all that is held."""
    def row() -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict({"page_id": pa.array([page], pa.int64()), "payload_bytes": pa.array([size], pa.int64()), "payload_digest": pa.array([digest.hexdigest()])})

    copy, page, size, digest = None, None, 0, hashlib.sha256()
    for batch in batches:
        for c, p, chunk in zip(*(batch.column(n) for n in ("copy", "page_id", "chunk")), strict=True):
            if c.as_py() != copy:
                if copy is not None:
                    yield row()
                copy, page, size, digest = c.as_py(), p.as_py(), 0, hashlib.sha256()
            part = chunk.as_buffer()
            digest.update(part)
            size += len(part)
    if copy is not None:
        yield row()


def payloads(found: DataFrame) -> DataFrame:
    """Records read back, one row per page: (page_id, payload_bytes, payload_digest, record_type, refers_to).

    Length and digest of a response come from its payload as read; of a revisit, from the
    header, since its payload is stored with the response.
    """
    whole = found.where("segment is null")
    revisit = F.col("type") == "revisit"
    one = whole.select("page_id", F.when(revisit, F.col("bytes")).otherwise(F.octet_length("chunk")).cast("long").alias("payload_bytes"),
                       F.when(revisit, F.col("digest")).otherwise(F.sha2(F.col("chunk").cast("binary"), 256)).alias("payload_digest"),
                       F.col("type").alias("record_type"), "refers_to")
    long = (found.where("segment is not null").repartition("copy").sortWithinPartitions("copy", "segment")
            .select("copy", "page_id", "chunk").mapInArrow(_digests, "page_id long, payload_bytes long, payload_digest string")
            .select("page_id", "payload_bytes", "payload_digest", F.lit("response").alias("record_type"), F.lit(None).cast("long").alias("refers_to")))
    return one.unionByName(long)


def op4_warc_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written to archives in the shared folder and read back."""
    path = os.path.join(scratch_path(spark, f"warc-{uuid.uuid4().hex}"))
    write_warc(table(spark, sf_dir, "pages"), path)
    return payloads(read_warc(spark, path))


ORACLE = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS payload FROM pages),
d AS (SELECT page_id, strlen(payload) AS payload_bytes, sha256(payload) AS payload_digest FROM p),
f AS (SELECT payload_digest, min(page_id) AS first FROM d WHERE payload_bytes >= {REVISIT_BYTES} GROUP BY 1)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN first <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN first <> page_id THEN first END AS refers_to
FROM d LEFT JOIN f USING (payload_digest)
"""
