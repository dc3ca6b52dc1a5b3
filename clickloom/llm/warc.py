"""WARC archives: writing captures and assembling their transactions again.

A capture is three records: a request, a response (or a revisit of an earlier response
with the same payload) and a metadata record. Request and metadata name the response in
WARC-Concurrent-To; reading joins the three through that identifier and gives one nested
row per capture.

Files go through Spark's text writer with gzip, so any file system that Spark reaches
will do, and task retries never leave half a file behind. A record is a row; the line
separator of the writer is the CRLF CRLF that ends a record.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from clickloom.llm.common import stored, text_of
from clickloom.session import work_path

# Fixed values of the WARC 1.1 format.
VERSION = "WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
CRLF = "\r\n"
MIN_REVISIT_BYTES = 100
FILE_BYTES = 16 << 20  # of records, before gzip
RECORD_SCHEMA = (
    "record_id string, warc_type string, concurrent_to string, refers_to string, "
    "target_uri string, warc_date string, header_digest string, http_length long, "
    "fields string, payload_bytes long, payload_digest string, payload binary")


def _uuid(*parts: Column | str) -> Column:
    hexed = F.md5(F.concat_ws("|", *parts))
    return F.concat(F.lit("<urn:uuid:"), *[
        p for i, (a, n) in enumerate([(1, 8), (9, 4), (13, 4), (17, 4), (21, 12)])
        for p in ([F.lit("-")] if i else []) + [F.substring(hexed, a, n)]], F.lit(">"))


def _lines(*pairs: tuple[str, Column]) -> Column:
    """Header lines; those with a null value are left out."""
    return F.concat_ws(CRLF, *[F.concat(F.lit(f"{name}: "), value) for name, value in pairs])


def _record(kind: Column, identity: Column, block: Column, *more: tuple[str, Column]) -> Column:
    head = _lines(("WARC-Type", kind), ("WARC-Record-ID", identity), *more,
                  ("Content-Length", F.octet_length(block).cast("string")))
    return F.concat(F.lit(VERSION + CRLF), head, F.lit(CRLF * 2), block)


def captures(pages: DataFrame, id_col: str = "page_id", url_col: str = "url",
             payload_col: str = "html") -> DataFrame:
    """page_id, url, payload, digest, bytes, copy and the page it revisits.

    Of captures with equal payloads of at least 100 bytes the one with the smallest id is
    the response. A null payload is empty, a null id comes before all others, and repeated
    rows are captures of their own: the first (by url) may be the response of the rest.
    """
    payload = text_of(payload_col)
    rows = pages.select(
        F.col(id_col).alias("page_id"), F.col(url_col).cast("string").alias("url"),
        payload.alias("payload"), F.sha2(payload.cast("binary"), 256).alias("digest"),
        F.octet_length(payload).cast("long").alias("bytes"))
    same = Window.partitionBy("page_id", "digest").orderBy("url")
    rows = rows.withColumn("copy", F.row_number().over(same))
    # min over structs, since min() alone would pass over a null id
    first = F.min(F.struct(F.col("page_id"))).alias("first")
    repeated = stored(pages.select(
        F.col(id_col).alias("page_id"), F.sha2(payload.cast("binary"), 256).alias("digest"),
        F.octet_length(payload).alias("bytes")).where(F.col("bytes") >= MIN_REVISIT_BYTES)
        .groupBy("digest").agg(first, F.count("*").alias("n"))
        .where("n > 1").select("digest", "first"), "warc-repeated")
    rows = rows.join(repeated, "digest", "left")
    is_first = F.col("page_id").eqNullSafe(F.col("first.page_id")) & (F.col("copy") == 1)
    return rows.select(
        "page_id", "url", "payload", "digest", "bytes", "copy",
        (F.col("first").isNotNull() & ~is_first).alias("revisit"),
        F.col("first.page_id").alias("first_page"))


def write_warc(pages: DataFrame, path: str, date: str = "2024-01-01T00:00:00Z",
               **columns: str) -> None:
    """Writes the captures of ``pages`` as gzipped WARC files below ``path``."""
    rows = captures(pages, **columns)
    page = F.coalesce(F.col("page_id").cast("string"), F.lit(""))
    uri = F.coalesce(F.regexp_replace("url", r"[\r\n]", ""), F.lit(""))
    own = _uuid(F.lit("response"), page, F.col("digest"), F.col("copy").cast("string"))
    first = _uuid(F.lit("response"), F.coalesce(F.col("first_page").cast("string"), F.lit("")),
                  F.col("digest"), F.lit("1"))
    digest = F.concat(F.lit("sha256:"), F.col("digest"))
    common = (("WARC-Date", F.lit(date)), ("WARC-Target-URI", uri))
    http = F.concat(
        F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "),
        F.col("bytes").cast("string"), F.lit(CRLF * 2))
    about = lambda kind: _uuid(F.lit(kind), own)
    response = _record(
        F.when(F.col("revisit"), F.lit("revisit")).otherwise(F.lit("response")), own,
        F.when(F.col("revisit"), http).otherwise(F.concat(http, F.col("payload"))), *common,
        ("WARC-Payload-Digest", digest), ("WARC-Profile", F.when(F.col("revisit"), F.lit(PROFILE))),
        ("WARC-Refers-To", F.when(F.col("revisit"), first)),
        ("Content-Type", F.lit("application/http; msgtype=response")))
    request = _record(
        F.lit("request"), about("request"),
        F.concat(F.lit("GET "), uri, F.lit(f" HTTP/1.1{CRLF * 2}")), *common,
        ("WARC-Concurrent-To", own), ("Content-Type", F.lit("application/http; msgtype=request")))
    fields = _lines(
        ("page-id", F.col("page_id").cast("string")), ("copy", F.col("copy").cast("string")),
        ("revisited-page-id", F.when(F.col("revisit"), F.col("first_page").cast("string"))))
    metadata = _record(
        F.lit("metadata"), about("metadata"), F.concat(fields, F.lit(CRLF)), *common,
        ("WARC-Concurrent-To", own), ("Content-Type", F.lit("application/warc-fields")))
    records = rows.select(F.explode(F.array(request, response, metadata)).alias("value"))
    records.write.option("lineSep", CRLF * 2).option("compression", "gzip").option(
        "maxRecordsPerFile", 3 * _rows_per_file(pages, columns.get("payload_col", "html"))).text(path)


def _rows_per_file(pages: DataFrame, payload_col: str) -> int:
    mean = pages.agg(F.avg(F.octet_length(text_of(payload_col)))).first()[0] or 0.0
    return max(1, int(FILE_BYTES / (mean + 1500)))


def parse_records(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers (lower-case names) and block of each record, by Content-Length."""
    at = 0
    while True:
        while data[at:at + 2] == b"\r\n":
            at += 2
        if at >= len(data):
            return
        end = data.index(b"\r\n\r\n", at)
        lines = data[at:end].decode().split(CRLF)
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"no WARC record at byte {at}")
        headers = {k.lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
        begin = end + 4
        at = begin + int(headers["content-length"])
        if at > len(data):
            raise ValueError("the last record is cut short")
        yield headers, data[begin:at]


def _unzipped(data: bytes) -> bytes:
    """All members of a gzip file, one per record or one for all; other files as they are."""
    parts = []
    while data[:2] == b"\x1f\x8b":
        member = zlib.decompressobj(31)
        parts.append(member.decompress(data))
        data = member.unused_data
    return b"".join([*parts, data])


def read_records(spark: SparkSession, path: str, payload: bool = False) -> DataFrame:
    """One row per record of the archives below ``path``; payloads only on request."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column("content"):
                data = content.as_buffer()
                data = _unzipped(data.to_pybytes())
                rows: list[tuple] = []
                size = 0
                for headers, block in parse_records(data):
                    rows.append(_row(headers, block, payload))
                    size += len(block)
                    if size > 4 << 20:
                        yield _batch(rows)
                        rows, size = [], 0
                yield _batch(rows)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    return files.select("content").mapInArrow(read, RECORD_SCHEMA)


def _row(headers: dict[str, str], block: bytes, payload: bool) -> tuple:
    kind, body, http_length, fields = headers["warc-type"], None, None, None
    if kind in ("response", "revisit"):
        head, _, body = block.partition(b"\r\n\r\n")
        found = re.search(rb"(?im)^content-length:\s*(\d+)", head)
        http_length = int(found[1]) if found else None
    elif kind == "metadata":
        fields = block.decode()
    has_body = kind == "response"
    return (
        headers["warc-record-id"], kind, headers.get("warc-concurrent-to"),
        headers.get("warc-refers-to"), headers.get("warc-target-uri"), headers.get("warc-date"),
        headers.get("warc-payload-digest"), http_length, fields,
        len(body) if has_body else None,
        hashlib.sha256(body).hexdigest() if has_body else None,
        body if has_body and payload else None)


_ARROW = pa.schema([
    ("record_id", pa.string()), ("warc_type", pa.string()), ("concurrent_to", pa.string()),
    ("refers_to", pa.string()), ("target_uri", pa.string()), ("warc_date", pa.string()),
    ("header_digest", pa.string()), ("http_length", pa.int64()), ("fields", pa.string()),
    ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("payload", pa.binary())])


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [[]] * len(_ARROW)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, f.type) for c, f in zip(columns, _ARROW, strict=True)], schema=_ARROW)


def transactions(records: DataFrame) -> DataFrame:
    """One nested row per capture: record_id, response, request and metadata structs.

    A response without request or metadata keeps a null there; of several requests (or
    metadata records) concurrent to one response the smallest record id is taken.
    """
    parts = records.where(F.col("warc_type").isin("request", "metadata")).groupBy(
        F.col("concurrent_to").alias("record_id")).agg(*[
            F.min(F.when(F.col("warc_type") == kind, F.struct(
                F.col("record_id").alias("id"), "target_uri", "warc_date", "fields"))).alias(kind)
            for kind in ("request", "metadata")])
    response = records.where(F.col("warc_type").isin("response", "revisit")).select(
        "record_id", F.struct(
            "warc_type", "target_uri", "warc_date", "refers_to", "header_digest", "http_length",
            "payload_bytes", "payload_digest", "payload").alias("response"))
    return response.join(parts, "record_id", "left")


def field(name: str) -> Column:
    """A value of the metadata record's fields."""
    found = F.regexp_extract("metadata.fields", rf"(?m)^{re.escape(name)}: (.*?)\r?$", 1)
    return F.when(found != "", found)


def round_trip(pages: DataFrame, payload: bool = False, **columns: str) -> DataFrame:
    """Writes ``pages`` to archives in the shared work folder and assembles them again."""
    path = work_path(pages.sparkSession, "warc")
    write_warc(pages, path, **columns)
    return transactions(read_records(pages.sparkSession, path, payload))
