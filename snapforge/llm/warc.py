"""WARC archives: records written as text, read back as a stream, and put together as one nested row per capture.

Archives are gzip files, so one task reads a file from begin to end and holds one record at a time; record borders come
from Content-Length, so a payload may contain anything, a record's first line included.

Rules: a null html is an empty payload, a null URL an empty one. Rows with equal payloads: those with the largest
page_id are responses, the others revisits of it (also those without a page_id); if none has a page_id all are responses.
Repeated rows give as many captures. Of several requests or metadata records that name one response, the one with the
smallest record id is taken; responses without any have null there.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from snapforge.llm.common import table, written
from snapforge.session import new_run_dir

MAGIC, GAP = "WARC/1.1\r\n", "\r\n\r\n"
DATE = "2024-01-01T00:00:00Z"
RECORDS_PER_FILE = 100_000
BATCH_BYTES = 4 << 20
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
RECORD = ("record_id string, record_type string, concurrent_to string, refers_to string, target_uri string, date string,"
          " payload_digest string, payload_bytes long, fields map<string,string>, payload binary")


def sha1_base32(text: Column) -> Column:
    """Five hexadecimal digits are four of base 32."""
    digest = F.sha1(text.cast("binary"))
    parts = [F.lpad(F.conv(F.substring(digest, k, 5), 16, 32), 4, "0") for k in range(1, 41, 5)]
    return F.translate(F.concat(*parts), "0123456789ABCDEFGHIJKLMNOPQRSTUV", BASE32)


def _urn(*parts: Column) -> Column:
    key = F.md5(F.concat_ws("|", *(F.coalesce(p.cast("string"), F.lit("")) for p in parts)))
    dashed = F.regexp_replace(key, "^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5")
    return F.concat(F.lit("<urn:uuid:"), dashed, F.lit(">"))


def _record(kind: Column | str, record_id: Column, uri: Column, block: Column, more: dict[str, Column]) -> Column:
    """One record without the gap after it; a header whose value is null is left out."""
    kind = F.lit(kind) if isinstance(kind, str) else kind
    lines = {"WARC-Type": kind, "WARC-Record-ID": record_id, "WARC-Date": F.lit(DATE), "WARC-Target-URI": uri} | more
    lines["Content-Length"] = F.octet_length(block).cast("string")
    texts = [F.coalesce(F.concat(F.lit(f"{k}: "), v, F.lit("\r\n")), F.lit("")) for k, v in lines.items()]
    return F.concat(F.lit(MAGIC), *texts, F.lit("\r\n"), block)


def records_of(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """``value``: request, response or revisit, and metadata of each page as text, a gap between them."""
    html = F.coalesce("html", F.lit(""))
    own = pages.select("page_id", F.coalesce("url", F.lit("")).alias("url"), html.alias("html"),
                       sha1_base32(html).alias("digest"), F.octet_length(html).cast("long").alias("bytes"))
    # a table of its own: the planner sees how few payloads are repeated and need not move the others to join them
    first = written(own.where(F.col("bytes") >= least_bytes).groupBy("digest", "bytes").agg(
        F.max("page_id").alias("original"), F.count("*").alias("copies"), F.max(F.struct("page_id", "url")).alias("row"),
    ).where("copies > 1 and original is not null").select(
        F.col("digest").alias("d"), F.col("bytes").alias("b"), "original", F.col("row.url").alias("original_url")), "originals")
    marked = own.join(first, (F.col("digest") == F.col("d")) & (F.col("bytes") == F.col("b")), "left").withColumn(
        "again", F.col("original").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("original")))
    uri = F.regexp_replace(F.regexp_replace("url", "\r", "%0D"), "\n", "%0A")
    capture = _urn(F.lit("response"), F.col("page_id"), F.col("url"), F.col("digest"))
    origin = _urn(F.lit("response"), F.col("original"), F.col("original_url"), F.col("digest"))
    again, digest = F.col("again"), F.concat(F.lit("sha1:"), F.col("digest"))
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
                    F.col("bytes").cast("string"), F.lit(GAP))
    path = F.regexp_extract(uri, "://[^/?#]*([^#]*)", 1)
    request = F.concat(F.lit("GET "), F.when(path == "", "/").otherwise(path), F.lit(" HTTP/1.1"), F.lit(GAP))
    facts = F.concat_ws("", F.concat(F.lit("page-id: "), F.col("page_id").cast("string"), F.lit("\r\n")), F.when(
        again, F.concat(F.lit("refers-to-page-id: "), F.col("original").cast("string"), F.lit("\r\n"))))
    profile = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
    message = {"Content-Type": F.lit("application/http; msgtype=response"), "WARC-Payload-Digest": digest}
    return marked.select(F.concat_ws(
        GAP,
        _record("request", _urn(F.lit("request"), F.col("page_id"), F.col("url"), F.col("digest")), uri, request,
                {"WARC-Concurrent-To": capture, "Content-Type": F.lit("application/http; msgtype=request")}),
        _record(F.when(again, "revisit").otherwise("response"), capture, uri,
                F.concat(http, F.when(again, "").otherwise(F.col("html"))),
                message | {"WARC-Refers-To": F.when(again, origin), "WARC-Profile": F.when(again, profile)}),
        _record("metadata", _urn(F.lit("metadata"), F.col("page_id"), F.col("url"), F.col("digest")), uri, facts,
                {"WARC-Concurrent-To": capture, "Content-Type": F.lit("application/warc-fields")}),
    ).alias("value"))


def write_archives(pages: DataFrame, folder: str, least_bytes: int = 0) -> None:
    records_of(pages, least_bytes).write.options(
        compression="gzip", lineSep=GAP, maxRecordsPerFile=str(RECORDS_PER_FILE)).text(folder)


def _headers(lines: list[bytes]) -> dict[str, str]:
    pairs = (line.partition(b":") for line in lines if b":" in line)
    return {k.decode(errors="replace").strip().lower(): v.decode(errors="replace").strip() for k, _, v in pairs}


def _read_record(data: bytes) -> tuple | None:
    """A row of RECORD; None if the record is cut short."""
    head, _, block = data.partition(GAP.encode())
    headers = _headers(head.split(b"\r\n"))
    length = int(headers["content-length"])
    if len(block) < length:
        return None
    block, kind, fields, payload = block[:length], headers.get("warc-type"), {}, None
    digest, size = headers.get("warc-payload-digest", "").rpartition(":")[2] or None, None
    if kind in ("response", "revisit", "request"):
        start, _, payload = block.partition(GAP.encode())
        fields = _headers(start.split(b"\r\n")[1:])
        size = len(payload)
    elif kind == "metadata":
        fields = _headers(block.split(b"\r\n"))
    if kind == "response":
        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
    elif kind == "revisit":
        size = int(fields["content-length"]) if fields.get("content-length", "").isdigit() else None
    return (headers.get("warc-record-id"), kind, headers.get("warc-concurrent-to"), headers.get("warc-refers-to"),
            headers.get("warc-target-uri"), headers.get("warc-date"), digest, size, fields, payload)


def _records(pieces: Iterator[tuple[bytes, str]]) -> Iterator[tuple]:
    """Records from what stands between first lines; a piece too short for its record goes on in the next one."""
    held, at, magic = b"", None, MAGIC.encode()
    parts: list[bytes] = []
    missing = 0
    for piece, file in pieces:
        if file != at:
            at, parts = file, []
        if not parts and not piece:
            continue  # before the first record of a file
        parts.append(piece)
        if len(parts) == 1:
            head, found, block = piece.partition(GAP.encode())
            length = int(_headers(head.split(b"\r\n")).get("content-length", 0)) if found else 0
            missing = length - len(block)
        else:
            missing -= len(magic) + len(piece)
        if missing <= 0:
            held, parts = magic.join(parts), []
            row = _read_record(held)
            if row is not None:
                yield row


ARROW = pa.schema([
    ("record_id", pa.string()), ("record_type", pa.string()), ("concurrent_to", pa.string()), ("refers_to", pa.string()),
    ("target_uri", pa.string()), ("date", pa.string()), ("payload_digest", pa.string()), ("payload_bytes", pa.int64()),
    ("fields", pa.map_(pa.string(), pa.string())), ("payload", pa.binary())])


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = [list(c) for c in zip(*rows, strict=True)]
    columns[8] = [list(m.items()) for m in columns[8]]
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, ARROW, strict=True)], schema=ARROW)


def _parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    pieces = ((v.as_py(), f.as_py()) for b in batches for v, f in zip(b.column(0), b.column(1), strict=True))
    rows, size = [], 0
    for row in _records(pieces):
        rows.append(row)
        size += len(row[9] or b"") + 512
        if size >= BATCH_BYTES:
            yield _batch(rows)
            rows, size = [], 0
    if rows:
        yield _batch(rows)


def read_archives(spark: SparkSession, folder: str) -> DataFrame:
    """Records of all gzip archives below ``folder``."""
    lines = spark.read.option("lineSep", MAGIC).text(folder)
    return lines.select(F.col("value").cast("binary"), F.input_file_name().alias("file")).mapInArrow(_parse, RECORD)


def captures(records: DataFrame) -> DataFrame:
    """One nested row per response or revisit, with the request and metadata that are concurrent to it."""
    def concurrent(kind: str) -> DataFrame:
        rows = records.where((F.col("record_type") == kind) & F.col("concurrent_to").isNotNull())
        entries = F.array_sort(F.map_entries("fields"))
        one = rows.groupBy("concurrent_to").agg(
            F.min(F.struct("record_id", "target_uri", "date", entries.alias("entries"))).alias("r"))
        return one.select(F.col("concurrent_to").alias(f"{kind}_of"), F.struct(
            "r.record_id", "r.target_uri", "r.date", F.map_from_entries("r.entries").alias("fields")).alias(kind))

    answers = records.where("record_type in ('response', 'revisit')")
    return (
        answers.join(concurrent("request"), F.col("record_id") == F.col("request_of"), "left")
        .join(concurrent("metadata"), F.col("record_id") == F.col("metadata_of"), "left")
        .select("record_id", "target_uri", "date", "request", F.struct(
            "record_type", "payload_bytes", "payload_digest", "refers_to", "fields", "payload").alias("response"),
            "metadata"))


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_run_dir(spark, "warc")
    write_archives(table(spark, sf_dir, "pages"), folder)
    rows = captures(written(read_archives(spark, folder), "records"))
    fact = F.col("metadata.fields")
    return rows.select(
        fact["page-id"].cast("long").alias("page_id"), "response.payload_bytes", "response.payload_digest",
        "response.record_type", fact["refers-to-page-id"].cast("long").alias("refers_to"))


_GROUPS = " || ".join(
    f"to_base(CAST('0x' || substr(sha1(coalesce(html, '')), {k}, 5) AS BIGINT), 32, 4)" for k in range(1, 41, 5))
SQL = {"op7_warc": f"""
WITH own AS (
  SELECT page_id, CAST(strlen(coalesce(html, '')) AS BIGINT) AS payload_bytes,
         translate({_GROUPS}, '0123456789ABCDEFGHIJKLMNOPQRSTUV', '{BASE32}') AS payload_digest
  FROM pages),
marked AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest, payload_bytes) AS original FROM own)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN original IS NOT NULL AND page_id IS DISTINCT FROM original THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id IS DISTINCT FROM original THEN original END AS refers_to
FROM marked
"""}
QUERIES = {"op7_warc": op7_warc}
