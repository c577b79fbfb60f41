"""WARC archives with revisit records for repeated payloads.

``write`` turns pages into WARC/1.1 records.  Headers only (page_id, length, SHA-1) are shuffled by payload
digest; of the records with equal payloads the one with the largest page_id is a response, the others become
revisit records that refer to it and carry no payload.  Payloads move once, by (page_id, digest), so a
digest with many copies is not one task.  Spark's text writer puts the records into gzip files; the record
end is its line separator.

``read_headers`` parses the archives by Content-Length and checks each response's payload against its digest;
``resolve`` shuffles the headers by digest and joins revisits to their originals.

Defined results: null payloads are empty; a null page_id is written as "null" and read back as null and never
wins against another; rows repeating page_id and payload are all responses if one is; control characters and
blanks in a URL are percent-encoded, a null URL has no WARC-Target-URI; no pages give an empty archive.
"""

from __future__ import annotations

import gzip
import hashlib
import io
import re
from base64 import b32encode

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from runsight.llm.common import written
from runsight.llm.groups import with_groups
from runsight.session import scratch_dir

BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
CRLF = "\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORDS_PER_FILE = 10_000
HEADER_SCHEMA = ("page_id long, record_type string, refers_to long, url string, payload_bytes long, "
                 "payload_digest string")


def base32_sha1(payload: Column) -> Column:
    """Upper-case base32 of the SHA-1 of a string's bytes."""
    digits = F.sha1(payload)
    chars = []
    for i in range(8):
        v = F.conv(F.substring(digits, 5 * i + 1, 5), 16, 10).cast("int")
        chars += [F.substr(F.lit(BASE32), F.shiftright(v, s).bitwiseAND(31) + 1, F.lit(1)) for s in (15, 10, 5, 0)]
    return F.concat(*chars)


def plan_records(pages: DataFrame, min_bytes: int = 0, html: str = "html", id_col: str = "page_id") -> DataFrame:
    """(page_id, payload_digest, refers_to) for each page to be written as a revisit."""
    body = F.coalesce(F.col(html), F.lit(""))
    heads = written(pages.select(F.col(id_col).cast("long").alias("page_id"), base32_sha1(body).alias("payload_digest"),
                                 F.octet_length(body).cast("long").alias("payload_bytes")), "heads")
    grouped = with_groups(written(heads.filter(F.col("payload_bytes") >= min_bytes), "heads_large"),
                          "payload_digest", "page_id", F.max)
    return (grouped.filter(~F.col("page_id").eqNullSafe(F.col("keep_id")))
            .groupBy("page_id", "payload_digest").agg(F.max("keep_id").alias("refers_to")))


def _urn(page_id: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), F.coalesce(page_id.cast("string"), F.lit("null")), F.lit(">"))


def write(pages: DataFrame, path: str, date: str, min_bytes: int = 0, html: str = "html", id_col: str = "page_id",
          url: str = "url", records_per_file: int = RECORDS_PER_FILE) -> None:
    """Write ``pages`` as deduplicated gzip WARC files below ``path``; ``date`` is the records' WARC-Date."""
    body = F.coalesce(F.col(html), F.lit(""))
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url).cast("string").alias("url"),
                        body.alias("body"), base32_sha1(body).alias("payload_digest"))
    plan = plan_records(pages, min_bytes, html, id_col).withColumn("is_revisit", F.lit(True))
    same = [F.coalesce(F.col("page_id").cast("string"), F.lit("null")).alias("pkey"), "payload_digest"]
    joined = (rows.select("*", same[0]).join(
        plan.select(same[0], "payload_digest", "refers_to", "is_revisit"), ["pkey", "payload_digest"], "left"))
    revisit = F.coalesce(F.col("is_revisit"), F.lit(False))
    uri = F.regexp_replace("url", r"[\x00-\x20\x7F]", "%20")
    http = F.concat(F.lit(CRLF.join(["HTTP/1.1 200 OK", "Content-Type: text/html; charset=utf-8", "Content-Length: "])),
                    F.octet_length("body").cast("string"), F.lit(CRLF * 2))
    length = F.octet_length(http) + F.when(revisit, 0).otherwise(F.octet_length("body"))

    def line(name: str, value: Column) -> Column:
        return F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit(CRLF)), F.lit(""))

    record = F.concat(
        F.lit("WARC/1.1" + CRLF), line("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        line("WARC-Record-ID", _urn(F.col("page_id"))), line("WARC-Date", F.lit(date)),
        line("WARC-Target-URI", uri), line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("payload_digest"))),
        line("WARC-Refers-To", F.when(revisit, _urn(F.col("refers_to")))),
        line("WARC-Profile", F.when(revisit, F.lit(PROFILE))),
        line("Content-Type", F.lit("application/http;msgtype=response")),
        line("Content-Length", length.cast("string")), F.lit(CRLF), http,
        F.when(revisit, F.lit("")).otherwise(F.col("body")))
    (joined.select(record.alias("value")).write.option("lineSep", CRLF * 2).option("compression", "gzip")
     .option("maxRecordsPerFile", records_per_file).text(path))


def _records(stream):
    """(header dict, block bytes) of each record of an uncompressed WARC stream."""
    while True:
        first = stream.readline()
        while first in (b"\r\n", b"\n"):
            first = stream.readline()
        if not first:
            return
        if not first.startswith(b"WARC/"):
            raise ValueError(f"no WARC record begins with {first[:40]!r}")
        head = {}
        while (text := stream.readline()) not in (b"\r\n", b"\n", b""):
            name, _, value = text.decode("utf-8").partition(":")
            head[name.strip().lower()] = value.strip()
        block = stream.read(int(head["content-length"]))
        if len(block) != int(head["content-length"]):
            raise ValueError("a WARC record ends too early")
        yield head, block


def _page(urn: str | None) -> int | None:
    found = re.fullmatch(r"<urn:page:(-?\d+)>", urn or "")
    return int(found[1]) if found else None


def _parse(batches):
    names = [f.split()[0] for f in HEADER_SCHEMA.split(", ")]
    types = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.string()]
    for batch in batches:
        for content in batch.column(0):
            rows = [[] for _ in names]
            for head, block in _records(gzip.GzipFile(fileobj=io.BytesIO(content.as_py()))):
                http, _, payload = block.partition(b"\r\n\r\n")
                digest = head["warc-payload-digest"].partition(":")[2]
                if head["warc-type"] == "response" and b32encode(hashlib.sha1(payload).digest()).decode() != digest:
                    raise ValueError(f"payload of {head['warc-record-id']} does not match its digest")
                size = int(re.search(rb"(?mi)^content-length: *(\d+)", http)[1])
                for column, value in zip(rows, (_page(head["warc-record-id"]), head["warc-type"],
                                                _page(head.get("warc-refers-to")), head.get("warc-target-uri"),
                                                size, digest), strict=True):
                    column.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(rows, types, strict=True)], names)


def read_headers(spark: SparkSession, path: str) -> DataFrame:
    """One row per record of the gzip archives below ``path``, one file at a time."""
    return (spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path).select("content")
            .mapInArrow(_parse, HEADER_SCHEMA))


def resolve(headers: DataFrame) -> DataFrame:
    """``headers`` with ``original``: the page_id of the response that a revisit stands for (null if absent).

    Headers are shuffled by digest with the heavy-hitter split; of several responses the largest page_id counts.
    """
    own = headers.withColumn("response_id", F.when(F.col("record_type") == "response", F.col("page_id")))
    joined = with_groups(written(own, "warc_headers"), "payload_digest", "response_id", F.max)
    return joined.select(*headers.columns,
                         F.when(F.col("record_type") == "revisit", F.col("keep_id")).alias("original"))


def archive_pages(pages: DataFrame, date: str = "2024-01-01T00:00:00Z", path: str | None = None) -> DataFrame:
    """Write ``pages`` to archives (below the shared folder unless ``path`` is given), read them back, resolve."""
    spark = pages.sparkSession
    path = path or scratch_dir(spark, "warc")
    write(pages, path, date)
    return resolve(read_headers(spark, path)).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", F.col("original").alias("refers_to"))
