"""WARC archives with revisit records in place of repeated payloads.

Headers are shuffled by payload digest, without the payloads: per digest the smallest page id is the original. Records
with an equal payload of at least ``MIN_PAYLOAD`` bytes become revisit records that refer to it, and lose their payload.
The archives are written by Spark's own writer, so a lost task leaves no half record behind: each row is one record
without its end, and the line separator of the text format is the end that the archive format asks for. Reading goes by
``Content-Length``, so payloads may hold anything.

Defined cases: a null payload is empty; a row with a null page id is always a response and never an original; rows that
share the smallest page id and the payload are all responses; a null or odd address is written percent-encoded.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

MIN_PAYLOAD = 100
END = b"\r\n\r\n"
#: Fixed values of the format.
VERSION = "WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"


def headers(pages: DataFrame, id_column: str = "page_id", payload_column: str = "html", url_column: str = "url") -> DataFrame:
    """``page_id, url, bytes, digest`` and the ``payload`` of each row."""
    payload = F.coalesce(F.col(payload_column).cast("string"), F.lit("")).cast("binary")
    return pages.select(
        F.col(id_column).cast("long").alias("page_id"),
        F.coalesce(F.regexp_replace(F.col(url_column), r"[\s\p{Cntrl}]", "%20"), F.lit("")).alias("url"),
        F.octet_length(payload).cast("long").alias("bytes"),
        F.sha2(payload, 256).alias("digest"),
        payload.alias("payload"),
    )


def originals(heads: DataFrame, min_payload: int = MIN_PAYLOAD) -> DataFrame:
    """Of each digest that occurs more than once, the smallest page id. Copies are combined before the shuffle."""
    return (
        heads.where((F.col("bytes") >= min_payload) & F.col("page_id").isNotNull())
        .groupBy("digest")
        .agg(F.min("page_id").alias("original"), F.max("page_id").alias("_last"))
        .where("_last > original")
        .select(F.col("digest").alias("original_digest"), "original")
    )


def resolve(heads: DataFrame, min_payload: int = MIN_PAYLOAD) -> DataFrame:
    """``heads`` with ``refers_to``, null for responses.

    The one row per repeated digest is the small side. Where it is too large to broadcast by itself, the copies of one
    digest are split by Spark's skew handling: both sides are plain shuffled inputs of the join.
    """
    match = (F.col("digest") == F.col("original_digest")) & (F.col("bytes") >= min_payload)
    revisit = F.col("page_id") > F.col("original")
    return (
        heads.join(originals(heads, min_payload), match, "left")
        .withColumn("refers_to", F.when(revisit, F.col("original")))
        .drop("original", "original_digest")
    )


def record_id(page: Column, digest: Column) -> Column:
    """The same name on each run."""
    h = F.md5(F.concat_ws("/", page.cast("string"), digest))
    return F.concat(F.lit("<urn:uuid:"), F.regexp_replace(h, r"^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5"), F.lit(">"))


def records(resolved: DataFrame, date: str = "2020-01-01T00:00:00Z") -> DataFrame:
    """One text per record, with fresh headers, without the end of the record."""
    revisit = F.col("refers_to").isNotNull()
    http = F.concat(F.lit(_HTTP), F.lit("Content-Length: "), F.col("bytes").cast("string"), F.lit("\r\n\r\n"))
    body = F.when(revisit, F.lit("")).otherwise(F.col("payload").cast("string"))
    length = F.octet_length(http) + F.when(revisit, 0).otherwise(F.col("bytes"))
    fields = [
        F.lit(VERSION),
        F.concat(F.lit("WARC-Type: "), F.when(revisit, F.lit("revisit")).otherwise(F.lit("response"))),
        F.concat(F.lit("WARC-Record-ID: "), record_id(F.col("page_id"), F.col("digest"))),
        F.lit(f"WARC-Date: {date}"),
        F.concat(F.lit("WARC-Target-URI: "), F.col("url")),
        F.concat(F.lit("WARC-Payload-Digest: sha256:"), F.col("digest")),
        # Null fields are left out by concat_ws.
        F.when(revisit, F.lit(f"WARC-Profile: {PROFILE}")),
        F.when(revisit, F.concat(F.lit("WARC-Refers-To: "), record_id(F.col("refers_to"), F.col("digest")))),
        F.concat(F.lit("X-Page-Id: "), F.col("page_id").cast("string")),
        F.when(revisit, F.concat(F.lit("X-Refers-To-Page: "), F.col("refers_to").cast("string"))),
        F.concat(F.lit("X-Payload-Length: "), F.col("bytes").cast("string")),
        F.lit("Content-Type: application/http; msgtype=response"),
        F.concat(F.lit("Content-Length: "), length.cast("string")),
    ]
    return resolved.select(F.concat(F.concat_ws("\r\n", *fields), F.lit("\r\n\r\n"), http, body).alias("value"))


def write_archives(pages: DataFrame, path: str, min_payload: int = MIN_PAYLOAD, records_per_file: int = 20_000, **columns: str) -> None:
    """Resolve revisits and write the archives, gzipped, of at most ``records_per_file`` records each."""
    out = records(resolve(headers(pages, **columns), min_payload))
    out.write.option("lineSep", END.decode()).option("compression", "gzip").option("maxRecordsPerFile", records_per_file).text(path)


def _parse(content: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields and block of each record of a gzipped file, unpacked piece by piece."""
    unpack, at, buffer, step = zlib.decompressobj(31), 0, bytearray(), 1 << 16

    def more() -> bool:
        nonlocal at
        if at >= len(content):
            return False
        buffer.extend(unpack.decompress(content[at : at + step]))
        at += step
        return True

    while True:
        seen = 0
        while (cut := buffer.find(END, seen)) < 0:
            seen = max(0, len(buffer) - 3)
            if not more():
                if buffer.strip():
                    raise ValueError("the archive ends inside a record")
                return
        fields = dict(line.split(": ", 1) for line in buffer[:cut].decode().split("\r\n")[1:])
        end = cut + 4 + int(fields["Content-Length"])
        while len(buffer) < end + 4:
            if not more():
                raise ValueError("the archive ends inside a record")
        if buffer[end : end + 4] != END:
            raise ValueError("a record is longer than it says")
        yield fields, bytes(buffer[cut + 4 : end])
        del buffer[: end + 4]


def read_archives(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """Records as rows: ``page_id, url, record_type, payload_bytes, payload_digest, refers_to`` and the ``payload``.

    Length and digest of a response are taken from the payload that was read and compared with the header; a revisit
    has those of its header, and a null payload.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column("content"):
                rows, size = [], 0
                for fields, block in _parse(content.as_py()):
                    length, digest = int(fields["X-Payload-Length"]), fields["WARC-Payload-Digest"].removeprefix("sha256:")
                    payload = None
                    if fields["WARC-Type"] == "response":
                        payload = block[block.index(END) + 4 :]
                        if len(payload) != length or hashlib.sha256(payload).hexdigest() != digest:
                            raise ValueError(f"damaged payload in record {fields['WARC-Record-ID']}")
                    page, refers = fields.get("X-Page-Id"), fields.get("X-Refers-To-Page")
                    row = (page and int(page), fields["WARC-Target-URI"], fields["WARC-Type"], length, digest, refers and int(refers))
                    rows.append((*row, payload) if payloads else row)
                    size += len(payload or b"") if payloads else 100
                    if size > 1 << 24:
                        yield table(rows)
                        rows, size = [], 0
                if rows:
                    yield table(rows)

    types = [("page_id", pa.int64(), "long"), ("url", pa.string(), "string"), ("record_type", pa.string(), "string")]
    types += [("payload_bytes", pa.int64(), "long"), ("payload_digest", pa.string(), "string"), ("refers_to", pa.int64(), "long")]
    types += [("payload", pa.binary(), "binary")] * payloads

    def table(rows: list[tuple]) -> pa.RecordBatch:
        return pa.record_batch([pa.array(c, t[1]) for c, t in zip(zip(*rows), types, strict=True)], names=[t[0] for t in types])

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    return files.select("content").mapInArrow(run, ", ".join(f"{n} {k}" for n, _, k in types))
