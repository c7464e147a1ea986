"""WARC archives without repeated payloads: revisit records point at one original response.

1. Headers (page id, payload digest, size) are reduced per digest, map-side first, to the largest
   page id; only digests that occur more than once stay.
2. Headers are joined with these originals by digest, each digest's headers being spread over
   several partitions. What isn't the original is a revisit.
3. Pages are joined with their revisit by page id, so payloads are never shuffled by a digest that
   a third of the pages may share. Each row becomes one WARC record with fresh headers, a revisit
   without the payload, and Spark's text writer writes the archives (a gzip member per record, a bounded
   number of records per file) with its own commit of whole tasks: a lost executor leaves no half archive.
4. Reading takes one archive per task and follows Content-Length, so payloads may hold anything.

A NULL payload is empty. Payloads below `MIN_REVISIT` bytes are always responses. Rows that repeat
the largest page id of a digest with the same payload all stay responses, as a page doesn't
revisit itself. NULL page ids sort below all others and read back as NULL.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mercato.llm.common import batches, id_text, salted_lookup, table
from mercato.llm.shingles import text_groups
from mercato.session import work_dir

MIN_REVISIT = 1000
RECORDS_PER_FILE = 500
CRLF = "\r\n"
RECORD_END = CRLF + CRLF
HTTP_HEAD = f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "


def revisits(pages: DataFrame) -> DataFrame:
    """(_key, _digest, refers_to, _refers_uri) of the pages whose payload another page stores."""
    headers = pages.filter(F.col("_bytes") >= MIN_REVISIT).select("page_id", "url", "_key", "_digest")
    originals = (
        headers.groupBy("_digest")
        .agg(F.max(F.struct("page_id", "url")).alias("_original"), F.count("*").alias("_records"))
        .filter("_records > 1")
        .select("_digest", F.col("_original.page_id").alias("refers_to"), F.col("_original.url").alias("_refers_uri"))
    )
    found = salted_lookup(headers, originals, "_digest", F.col("_key"))
    later = found.filter("refers_to is not null and not (page_id <=> refers_to)")
    return later.select("_key", "_digest", "refers_to", "_refers_uri").distinct()


def _uuid(digest: Column) -> Column:
    return F.concat_ws(
        "-", *(F.substring(digest, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12)))
    )


def _base32(hex_digest: Column) -> Column:
    """A SHA-1 in base 32, as WARC headers have it: 8 pieces of 5 hexadecimal digits, 4 letters each."""
    letters = F.lit("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")

    def letter(piece: int, k: int) -> Column:
        number = F.conv(F.substring(hex_digest, 1 + 5 * piece, 5), 16, 10).cast("int")
        return F.substring(letters, F.shiftright(number, 15 - 5 * k).bitwiseAND(31) + 1, F.lit(1))

    return F.concat(*(letter(piece, k) for piece in range(8) for k in range(4)))


def _record_id(page_id: Column, digest: Column) -> Column:
    return _uuid(F.md5(F.concat_ws("|", F.lit("record"), page_id.cast("string"), digest)))


def _uri(url: Column) -> Column:
    """A header ends at the line end, so control characters of a URL are left out."""
    return F.regexp_replace(url, r"[\x00-\x20\x7F]", "")


def records(pages: DataFrame, written_at: str) -> DataFrame:
    """One record per row as text, without the final blank lines."""
    original = F.col("refers_to")
    is_revisit = original.isNotNull()
    head = F.concat(F.lit(HTTP_HEAD), F.col("_bytes").cast("string"), F.lit(RECORD_END))
    block = F.concat(head, F.when(is_revisit, F.lit("")).otherwise(F.col("_payload")))
    fields = [
        ("WARC-Type", F.when(is_revisit, F.lit("revisit")).otherwise(F.lit("response"))),
        ("WARC-Record-ID", F.concat(F.lit("<urn:uuid:"), _record_id(F.col("page_id"), F.col("_digest")), F.lit(">"))),
        ("WARC-Date", F.lit(written_at)),
        ("WARC-Target-URI", _uri(F.coalesce("url", F.lit("")))),
        ("WARC-Payload-Digest", F.concat(F.lit("sha1:"), _base32(F.col("_digest")))),
        ("WARC-Profile", F.when(is_revisit, F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"))),
        (
            "WARC-Refers-To",
            F.when(is_revisit, F.concat(F.lit("<urn:uuid:"), _record_id(original, F.col("_digest")), F.lit(">"))),
        ),
        ("WARC-Refers-To-Target-URI", F.when(is_revisit, _uri(F.col("_refers_uri")))),
        ("WARC-Refers-To-Date", F.when(is_revisit, F.lit(written_at))),
        ("X-Page-ID", F.col("page_id").cast("string")),
        ("X-Refers-To-Page-ID", original.cast("string")),
        ("Content-Type", F.lit("application/http;msgtype=response")),
        ("Content-Length", F.octet_length(block).cast("string")),
    ]
    lines = [F.when(value.isNotNull(), F.concat(F.lit(f"{name}: "), value)) for name, value in fields]
    return pages.select(F.concat(F.concat_ws(CRLF, F.lit("WARC/1.1"), *lines), F.lit(RECORD_END), block).alias("value"))


def member(record: bytes) -> bytes:
    """A record as a gzip member whose last byte is 0, without that byte.

    A member ends with its size in four bytes, the highest last. From 16 MB on that isn't 0, and an empty member
    follows.
    """
    out = gzip.compress(record, 6, mtime=0)
    if out[-1]:
        out += gzip.compress(b"", mtime=0)
    return out[:-1]


def _members(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    end = RECORD_END.encode()
    for part in parts:
        # Some records at a time, as they may be long.
        for _, texts in text_groups(part.column("value")):
            packed = [member(t.encode() + end) for t in texts]
            yield pa.RecordBatch.from_arrays([pa.array(packed, pa.binary())], names=["value"])


def write_archives(pages: DataFrame, path: str, written_at: str = "2024-01-01T00:00:00Z") -> None:
    """Write `pages` (page_id, url, html) as WARC archives into the new folder `path`."""
    payload = F.coalesce(F.col("html"), F.lit(""))
    full = pages.select(
        "page_id",
        "url",
        id_text("page_id").alias("_key"),
        payload.alias("_payload"),
        F.octet_length(payload).alias("_bytes"),
        F.sha1(payload.cast("binary")).alias("_digest"),
    )
    found = records(full.join(revisits(full), ["_key", "_digest"], "left"), written_at)
    # The writer ends each row with the byte that members lack.
    found.mapInArrow(_members, "value binary").select(F.col("value").cast("string")).write.options(
        lineSep="\0", compression="none", maxRecordsPerFile=RECORDS_PER_FILE
    ).text(path)


def parse(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """The records of an archive: headers by lower-case name, and the block."""
    at = 0
    while at < len(data):
        end = data.index(b"\r\n\r\n", at)
        lines = data[at:end].decode().split(CRLF)
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"no WARC record at byte {at}")
        headers = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
        start = end + 4
        at = start + int(headers["content-length"])
        if data[at : at + 4] != b"\r\n\r\n":
            raise ValueError(f"record doesn't end at byte {at}")
        yield headers, data[start:at]
        at += 4


READ_SCHEMA = (
    "page_id bigint, url string, payload string, payload_bytes bigint, payload_digest string,"
    " record_type string, refers_to bigint"
)


def read_archives(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """The records below `path`; digests of responses are computed anew and must agree."""
    kinds = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64()]
    names = [x.split()[0] for x in READ_SCHEMA.split(", ")]
    schema = pa.schema(list(zip(names, kinds, strict=True)))

    def rows(data: bytes) -> Iterator[tuple]:
        for headers, block in parse(data):
            head, _, payload = block.partition(b"\r\n\r\n")
            stated = base64.b32decode(headers["warc-payload-digest"].removeprefix("sha1:")).hex()
            kind = headers["warc-type"]
            size = int(head.rpartition(b"Content-Length: ")[2])
            if kind == "response" and (hashlib.sha1(payload).hexdigest() != stated or len(payload) != size):
                raise ValueError(f"payload of {headers['warc-record-id']} doesn't agree with its digest")
            yield (
                int(headers["x-page-id"]) if "x-page-id" in headers else None,
                headers.get("warc-target-uri"),
                payload.decode() if payloads and kind == "response" else None,
                size,
                stated,
                kind,
                int(headers["x-refers-to-page-id"]) if "x-refers-to-page-id" in headers else None,
            )

    def read(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for content in part.column("content"):
                data = content.as_py()
                yield from batches(schema, rows(gzip.decompress(data) if data else b""), RECORDS_PER_FILE)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    return files.select("content").mapInArrow(read, READ_SCHEMA)


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = work_dir(spark, "warc")
    write_archives(table(spark, sf_dir, "pages").select("page_id", "url", "html"), path)
    return read_archives(spark, path, payloads=False).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


ORACLE = f"""
  with p as (select page_id, coalesce(html, '') html, octet_length(encode(coalesce(html, ''))) n from pages),
    d as (select page_id, n, sha1(html) digest from p),
    o as (select digest, max(page_id) original from d where n >= {MIN_REVISIT} group by digest having count(*) > 1)
  select page_id, n::bigint payload_bytes, digest payload_digest,
    case when original is null or page_id = original then 'response' else 'revisit' end record_type,
    case when page_id <> original then original end refers_to
  from d left join o using (digest)
"""
