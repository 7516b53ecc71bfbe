"""WARC archives without repeated payloads.

``write_archive`` decides on headers alone: (id, digest, length) rows meet by payload digest, the
smallest id of a digest becomes the response, and the others become revisit records that refer to it.
The decisions then meet the pages once, and Spark's text writer writes one record per row with fresh
headers, gzipped per file; its line separator is the blank line that ends a WARC record. ``read_archive`` reads whole
files, walks the records by Content-Length, digests the payloads anew, and joins each revisit to its
response for the length of the full payload.

Files are dealt by page id into as many partitions as the total of bytes asks for, so that a file
stays near ``FILE_BYTES`` at every size of input; one payload is never split. Everything is written
below the shared folder by Spark's committer, so a lost task writes its file again.

Defined cases: a null html is an empty payload; payloads under ``MIN_REVISIT`` bytes are always
responses; rows repeated with the same id and payload are the same capture and all written as
responses when theirs is the smallest id; a null page id sorts after all others and reads back as
null; control characters and blanks in a URL are percent-coded; an empty table gives an empty archive.
"""

from __future__ import annotations

import gzip
import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import new_folder, settle

MIN_REVISIT = 100
FILE_BYTES = 32 << 20
DATE = "1970-01-01T00:00:00Z"
END = "\r\n\r\n"
# Fixed values of the WARC 1.1 format.
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "
RECORD_ID = "urn:page:"


def decide(headers: DataFrame, min_revisit: int = MIN_REVISIT) -> DataFrame:
    """``page_id, digest, refers_to`` of the records that become revisits."""
    large = headers.where(F.col("n_bytes") >= min_revisit).select("page_id", "digest")
    first = large.groupBy("digest").agg(F.min("page_id").alias("refers_to"), F.count(F.lit(1)).alias("n"))
    return (
        large.join(first.where("n > 1"), "digest")
        .where(~F.col("page_id").eqNullSafe(F.col("refers_to")))
        .select("page_id", "digest", "refers_to")
        .distinct()
    )


def _record() -> F.Column:
    """One WARC record as text, without the blank line after it."""
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))
    key = F.coalesce(F.col("page_id").cast("string"), F.lit("null"))
    http = F.concat(F.lit(HTTP), F.col("n_bytes").cast("string"), F.lit(END))
    revisit = F.col("refers_to").isNotNull()
    body = F.when(revisit, http).otherwise(F.concat(http, F.col("payload")))
    return F.concat(
        F.lit("WARC/1.1\r\n"),
        line("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        line("WARC-Record-ID", F.concat(F.lit(f"<{RECORD_ID}"), key, F.lit(">"))),
        line("WARC-Date", F.lit(DATE)),
        line("WARC-Target-URI", F.col("uri")),
        line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("digest"))),
        F.when(
            revisit,
            F.concat(
                line("WARC-Profile", F.lit(PROFILE)),
                line("WARC-Refers-To", F.concat(F.lit(f"<{RECORD_ID}"), F.col("refers_to").cast("string"), F.lit(">"))),
            ),
        ).otherwise(""),
        line("Content-Type", F.lit("application/http; msgtype=response")),
        F.lit("Content-Length: "),
        F.octet_length(body).cast("string"),
        F.lit(END),
        body,
    )


def write_archive(pages: DataFrame, path: str, min_revisit: int = MIN_REVISIT, file_bytes: int = FILE_BYTES) -> None:
    """Write ``pages`` (page_id, url, html) as WARC files below ``path``."""
    uri = F.regexp_replace(F.coalesce(F.col("url"), F.lit("urn:none")), r"[\x00-\x20\x7F]", "%20")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), uri.alias("uri"), F.coalesce("html", F.lit("")).alias("payload"))
    rows = rows.withColumns({"digest": F.sha2("payload", 256), "n_bytes": F.octet_length("payload").cast("long")})
    headers = settle(rows.select("page_id", "digest", "n_bytes"), "warc-headers")
    total = headers.agg(F.sum(F.col("n_bytes") + 512)).first()[0] or 0
    revisits = decide(headers, min_revisit)
    files = rows.repartition(max(1, -(-total // file_bytes)), "page_id", "digest")
    (
        files.join(revisits, ["page_id", "digest"], "left")
        .select(_record().alias("value"))
        .write.option("lineSep", END)
        .option("compression", "gzip")
        .text(path)
    )


def records(content: bytes) -> Iterator[tuple[dict[str, str], memoryview]]:
    """Headers and block of each record of a WARC file."""
    at, view = 0, memoryview(content)
    while at < len(content):
        end = content.index(b"\r\n\r\n", at)
        lines = content[at:end].decode().split("\r\n")
        headers = dict(x.split(": ", 1) for x in lines[1:])
        start = end + 4
        stop = start + int(headers["Content-Length"])
        if content[stop : stop + 4] != b"\r\n\r\n":
            raise ValueError(f"record at byte {at} does not end where its length says")
        yield headers, view[start:stop]
        at = stop + 4


_READ = "page_id long, uri string, record_type string, digest string, refers_to long, payload_bytes long, payload binary"


def _number(record_id: str | None) -> int | None:
    found = re.search(rf"{RECORD_ID}(-?\d+)", record_id or "")
    return int(found[1]) if found else None


def _parse(batches: Iterator[pa.RecordBatch], with_payload: bool) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for content in batch.column(0):
            out: list[tuple] = []
            size = 0
            for head, block in records(gzip.decompress(content.as_py())):
                digest = head["WARC-Payload-Digest"].removeprefix("sha256:")
                length = payload = None
                if head["WARC-Type"] == "response":
                    body = bytes(block).split(b"\r\n\r\n", 1)[1]
                    length, payload = len(body), body if with_payload else None
                    if hashlib.sha256(body).hexdigest() != digest:
                        raise ValueError(f"payload of {head['WARC-Record-ID']} does not have its digest")
                out.append(
                    (
                        _number(head["WARC-Record-ID"]),
                        head["WARC-Target-URI"],
                        head["WARC-Type"],
                        digest,
                        _number(head.get("WARC-Refers-To")),
                        length,
                        payload,
                    )
                )
                size += len(payload or b"")
                if size > FILE_BYTES:
                    yield _batch(out)
                    out, size = [], 0
            if out:
                yield _batch(out)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    types = [pa.int64(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.binary()]
    names = ["page_id", "uri", "record_type", "digest", "refers_to", "payload_bytes", "payload"]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)


def read_archive(spark: SparkSession, path: str, with_payload: bool = False) -> DataFrame:
    """All records of an archive; a revisit has the length of the payload it refers to."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("content")
    read = files.mapInArrow(lambda batches: _parse(batches, with_payload), _READ)
    if not with_payload:
        read = settle(read.drop("payload"), "warc-read")
    answers = read.where("record_type = 'response'")
    lengths = answers.groupBy(F.col("page_id").alias("refers_to"), "digest").agg(F.max("payload_bytes").alias("full"))
    again = read.where("record_type = 'revisit'").join(lengths, ["refers_to", "digest"], "left")
    again = again.withColumn("payload_bytes", F.col("full")).select(*read.columns)
    return answers.unionByName(again)


def archive_pages(pages: DataFrame, min_revisit: int = MIN_REVISIT) -> DataFrame:
    """Write an archive of ``pages``, read it back, and return a row per record."""
    spark = pages.sparkSession
    path = new_folder(spark, "warc")
    write_archive(pages, path, min_revisit)
    return read_archive(spark, path)
