"""WARC archives: writing records from a table, resolving revisits of equal payloads, reading archives back.

Payloads are UTF-8 text, so a whole record is, and Spark's text writer with the record end as its line separator
writes gzipped WARC/1.1 files into any store. Archives hold a bounded number of records each and are read back
record by record, by the lengths in their headers, never by searching payloads for separators.
"""

from __future__ import annotations

import gzip
import hashlib
from collections.abc import Iterator
from typing import BinaryIO

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Payloads of fewer bytes are always stored.
MIN_BYTES = 1000
#: Records of one archive file at most.
FILE_RECORDS = 4000
#: Bytes of payloads that are read before they are handed on, about.
BATCH_BYTES = 8 << 20
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_READ = "record_id string, page_id long, record_type string, target_uri string, refers_to_record string, payload_digest string, payload_bytes long"


def _record_id(page_id: Column, digest: Column) -> Column:
    """A record's identifier, the same when a lost task runs again."""
    h = F.md5(F.concat_ws("/", F.coalesce(page_id.cast("string"), F.lit("")), digest))
    return F.concat_ws("-", F.substring(h, 1, 8), F.substring(h, 9, 4), F.substring(h, 13, 4), F.substring(h, 17, 4), F.substring(h, 21, 12))


def resolve_revisits(pages: DataFrame, *, id: str = "page_id", url: str = "url", html: str = "html", min_bytes: int = MIN_BYTES) -> DataFrame:
    """``id``, ``url``, ``html``, ``digest``, ``n_bytes``, and for revisits ``original`` and ``original_url``.

    Headers alone are shuffled by digest: among equal payloads of ``min_bytes`` or more, the greatest id is the
    response. Payloads meet their revisit mark by id, so a payload that many pages share gathers nowhere. A null html is an
    empty payload; rows that agree in id and payload are treated alike; a null id is never a revisit.
    """
    rows = pages.select(F.col(id).alias("id"), F.col(url).alias("url"), F.coalesce(F.col(html), F.lit("")).alias("html"))
    rows = rows.withColumn("digest", F.sha1("html")).withColumn("n_bytes", F.octet_length("html").cast("long"))
    headers = rows.where(F.col("n_bytes") >= min_bytes).select("id", "digest", "url")
    originals = headers.groupBy("digest").agg(F.max("id").alias("original"), F.max_by(F.coalesce("url", F.lit("")), "id").alias("original_url"), F.count(F.lit(1)).alias("_n"))
    revisits = headers.select("id", "digest").distinct().join(originals.where("_n > 1").drop("_n"), "digest").where(F.col("id") < F.col("original"))
    return rows.join(revisits, ["id", "digest"], "left").select("id", "url", "html", "digest", "n_bytes", "original", "original_url")


def _header(name: str, value: Column) -> Column:
    """A header line, empty where the value is null; control characters and spaces are escaped as in URIs."""
    clean = F.regexp_replace(F.regexp_replace(F.regexp_replace(value, "\r", "%0D"), "\n", "%0A"), " ", "%20")
    return F.coalesce(F.concat(F.lit(f"{name}: "), clean, F.lit("\r\n")), F.lit(""))


def write_archives(resolved: DataFrame, path: str, *, date: str, file_records: int = FILE_RECORDS) -> None:
    """Write a record for each row of ``resolve_revisits``: a response with the payload, or a revisit that refers to one."""
    again = F.col("original").isNotNull()
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.col("n_bytes").cast("string"), F.lit("\r\n\r\n"))
    block = F.when(again, http).otherwise(F.concat(http, F.col("html")))
    urn = lambda i: F.concat(F.lit("<urn:uuid:"), _record_id(i, F.col("digest")), F.lit(">"))
    only = lambda value: F.when(again, value)
    record = F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: "), F.when(again, "revisit").otherwise("response"), F.lit("\r\n"),
        _header("WARC-Record-ID", urn(F.col("id"))),
        _header("WARC-Date", F.lit(date)),
        _header("WARC-Target-URI", F.col("url")),
        _header("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
        _header("WARC-Profile", only(F.lit(_PROFILE))),
        _header("WARC-Refers-To", only(urn(F.col("original")))),
        _header("WARC-Refers-To-Target-URI", only(F.nullif(F.col("original_url"), F.lit("")))),
        _header("WARC-Refers-To-Date", only(F.lit(date))),
        _header("X-Page-ID", F.col("id").cast("string")),
        F.lit("Content-Type: application/http; msgtype=response\r\nContent-Length: "), F.octet_length(block).cast("string"), F.lit("\r\n\r\n"),
        block,
    )
    resolved.select(record.alias("value")).write.option("lineSep", "\r\n\r\n").option("maxRecordsPerFile", file_records).option("compression", "gzip").text(path)


def parse(archive: BinaryIO) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers (by lower-case name) and block of each record of an unpacked archive, which is read record by record."""
    while version := archive.readline():
        if not version.startswith(b"WARC/1."):
            raise ValueError(f"no WARC record at byte {archive.tell() - len(version)}")
        headers = {}
        while line := archive.readline().decode().rstrip("\r\n"):
            k, _, v = line.partition(":")
            headers[k.lower()] = v.strip()
        block = archive.read(n := int(headers["content-length"]))
        if len(block) < n or archive.read(4) != b"\r\n\r\n":
            raise ValueError(f"a record doesn't end at byte {archive.tell()}")
        yield headers, block


def read_archives(spark: SparkSession, path: str, *, payload: bool = False) -> DataFrame:
    """A row for each record of the archives under ``path``; with ``payload``, the payload of responses too.

    The digest and the number of bytes of a response are those of the payload as read; a payload that differs from its
    header's digest is an error. Of revisits they are null until ``follow_revisits``. An archive is unpacked record by record, whether it
    is one gzip member or has one for each record; beside its packed bytes a task holds a record, and about BATCH_BYTES of payloads if they are asked for.
    """
    schema = _READ + (", payload binary" if payload else "")
    kinds = [pa.string(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.binary()]
    names = [x.split()[0] for x in schema.split(", ")]

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*rows), kinds)], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for archive in (x for batch in batches for x in batch.column(0)):
            rows, held = [], 0
            for h, block in parse(gzip.GzipFile(fileobj=pa.BufferReader(archive.as_buffer()))):
                body = digest = None
                if h["warc-type"] == "response":
                    body = block.partition(b"\r\n\r\n")[2]
                    digest = hashlib.sha1(body).hexdigest()
                    if h["warc-payload-digest"] != f"sha1:{digest}":
                        raise ValueError(f"the payload of {h['warc-record-id']} differs from its digest")
                page = h.get("x-page-id")
                rows.append((h["warc-record-id"], int(page) if page else None, h["warc-type"], h.get("warc-target-uri"), h.get("warc-refers-to"), digest, None if body is None else len(body), *([body] if payload else [])))
                held += len(body or b"") if payload else 0
                if held >= BATCH_BYTES:
                    yield batch_of(rows)
                    rows, held = [], 0
            if rows:
                yield batch_of(rows)

    return spark.read.format("binaryFile").load(path).where(F.col("length") > 0).select("content").mapInArrow(run, schema)


def follow_revisits(records: DataFrame) -> DataFrame:
    """``read_archives`` with the digest, bytes and page of the response in each revisit; ``refers_to`` is that page.

    A revisit whose response is missing keeps nulls.
    """
    found = records.where("record_type = 'response'").select(F.col("record_id").alias("refers_to_record"), F.col("page_id").alias("_page"), F.col("payload_digest").alias("_digest"), F.col("payload_bytes").alias("_bytes")).dropDuplicates(["refers_to_record"])
    revisits = records.where("record_type = 'revisit'").join(found, "refers_to_record", "left")
    revisits = revisits.withColumns({"payload_digest": F.col("_digest"), "payload_bytes": F.col("_bytes"), "refers_to": F.col("_page")}).drop("_digest", "_bytes", "_page")
    return records.where("record_type <> 'revisit'").withColumn("refers_to", F.lit(None).cast("long")).unionByName(revisits)
