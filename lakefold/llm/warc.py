"""WARC archives with revisit records.

Pages become WARC records.  Headers (id, payload digest, size) are shuffled by digest; of the records with one payload the
smallest page id keeps it and the others become revisit records that refer to it.  Archives are written by Spark's text
writer: a record ends with two line breaks, which is the row separator given to it, so the files reach any file system with
Spark's commit protocol.  They are read back record by record, by Content-Length.

Defined results: null html is an empty payload; null urls become ``urn:page:<id>``; blanks and control characters in a url
are written as %20; a null page_id counts as larger than all others and is written without the page header; repeated rows are written
as often as they come, and those of a response are responses; payloads below ``least_bytes`` are never revisits; an empty
table gives an archive without records.  Only ``page_id, url, html`` are read.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakefold.llm.common import new_folder, written

# Fixed values of the format (WARC 1.1, RFC 4648).
END = "\r\n"
HEX32, BASE32 = "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
IDENTICAL = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
PAGE_HEADER = "X-Page-ID"

RECORDS_PER_FILE = 4000
READ_BYTES = 1 << 20
RECORD_COLUMNS = (
    "record_id string, warc_type string, page_id long, target_uri string, payload_digest string, "
    "payload_bytes long, refers_to_record string, digest_ok boolean"
)


def base32_sha1(payload: Column) -> Column:
    """Upper-case base32 of the SHA-1 of a binary or text column."""
    digest = F.sha1(payload)
    groups = [
        F.lpad(F.conv(F.substring(digest, i, 5), 16, 32), 4, "0") for i in range(1, 41, 5)
    ]
    return F.translate(F.concat(*groups), HEX32, BASE32)


def record_id(page_id: Column, digest: Column) -> Column:
    name = F.md5(F.concat_ws("/", page_id.cast("string"), digest))
    parts = [F.substring(name, *at) for at in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *parts), F.lit(">"))


def _pages(pages: DataFrame) -> DataFrame:
    html = F.coalesce(F.col("html"), F.lit(""))
    url = F.coalesce(F.col("url"), F.concat(F.lit("urn:page:"), F.coalesce(F.col("page_id").cast("string"), F.lit(""))))
    return pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.regexp_replace(url, r"[\x00-\x20\x7F]", "%20").alias("url"),
        html.alias("html"),
        base32_sha1(html).alias("digest"),
        F.octet_length(html).cast("long").alias("bytes"),
    )


def resolve(heads: DataFrame, least_bytes: int = 0) -> DataFrame:
    """``page_id, digest, original``: for each distinct header the header that holds its payload.

    ``original`` is a struct ``page_id, url``, null for a record that keeps its own payload.
    Each digest is first reduced to its smallest id, so a payload with any number of copies sends one row per task.
    """
    last = F.coalesce(F.col("page_id"), F.lit(2**63 - 1))
    originals = (
        heads.where(F.col("bytes") >= least_bytes).groupBy("digest")
        .agg(F.min(F.struct(last.alias("order"), "page_id", "url")).alias("first"))
    )
    originals = written(originals, "originals")  # so that the join can split a payload with very many copies
    return (
        heads.groupBy("page_id", "digest").agg(F.first("bytes").alias("bytes"))
        .join(originals, "digest", "left")
        .select(
            "page_id", "digest",
            F.when(~F.col("page_id").eqNullSafe(F.col("first.page_id")),
                   F.when(F.col("bytes") >= least_bytes, F.struct("first.page_id", "first.url"))).alias("original"),
        )
    )


def record_text(date: str) -> Column:
    """One record without its closing line breaks, from ``page_id, url, html, digest, bytes, original``."""
    revisit = F.col("original").isNotNull()
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{END}Content-Type: text/html; charset=utf-8{END}Content-Length: "),
                    F.col("bytes").cast("string"), F.lit(END + END))
    body = F.when(revisit, F.lit("")).otherwise(F.col("html"))

    def header(name: str, value: Column) -> Column:
        return F.concat(F.lit(f"{name}: "), value, F.lit(END))  # null without a value

    original_id = record_id(F.col("original.page_id"), F.col("digest"))
    lines = [
        F.lit(f"WARC/1.1{END}"),
        header("WARC-Type", F.when(revisit, F.lit("revisit")).otherwise(F.lit("response"))),
        header("WARC-Record-ID", record_id(F.col("page_id"), F.col("digest"))),
        F.lit(f"WARC-Date: {date}{END}"),
        header("WARC-Target-URI", F.col("url")),
        header("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
        header(PAGE_HEADER, F.col("page_id").cast("string")),
        header("WARC-Profile", F.when(revisit, F.lit(IDENTICAL))),
        header("WARC-Refers-To", F.when(revisit, original_id)),
        header("WARC-Refers-To-Target-URI", F.col("original.url")),
        F.when(revisit, F.lit(f"WARC-Refers-To-Date: {date}{END}")),
        F.lit(f"Content-Type: application/http;msgtype=response{END}"),
        header("Content-Length", (F.octet_length(http) + F.octet_length(body)).cast("string")),
    ]
    return F.concat(*[F.coalesce(line, F.lit("")) for line in lines], F.lit(END), http, body)


def write_archives(pages: DataFrame, path: str, least_bytes: int = 0,
                   date: str = "2024-01-01T00:00:00Z") -> None:
    """Write ``pages`` as gzipped WARC files below ``path``, equal payloads once."""
    pages = _pages(pages)
    decided = resolve(pages.select("page_id", "url", "digest", "bytes"), least_bytes).select(
        F.col("page_id").alias("_id"), F.col("digest").alias("_digest"), "original"
    )
    joined = pages.join(
        decided, pages["page_id"].eqNullSafe(F.col("_id")) & (F.col("digest") == F.col("_digest"))
    )
    (
        joined.select(record_text(date).alias("value")).write.option("lineSep", END + END)
        .option("compression", "gzip").option("maxRecordsPerFile", RECORDS_PER_FILE).text(path)
    )


def parse_records(data: Iterator[bytes]) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers (names in lower case) and block of each record of an archive given in pieces."""
    held = bytearray()

    def more() -> bool:
        piece = next(data, None)
        if piece is not None:
            held.extend(piece)
        return piece is not None

    while True:
        while (end := held.find(b"\r\n\r\n")) < 0 and more():
            pass
        if end < 0:
            if held.strip():
                raise ValueError("archive ends within a record's headers")
            return
        first, *lines = held[:end].decode("utf-8").split(END)
        if not first.startswith("WARC/"):
            raise ValueError(f"no record starts at {first[:40]!r}")
        headers = {name.strip().lower(): value.strip() for name, _, value in (x.partition(":") for x in lines)}
        length = int(headers["content-length"])
        while len(held) < end + 4 + length + 4:
            if not more():
                raise ValueError("archive ends within a record")
        yield headers, bytes(held[end + 4 : end + 4 + length])
        del held[: end + 4 + length + 4]


def _unzipped(content: bytes) -> Iterator[bytes]:
    """Pieces of a gzip file of any number of members."""
    while content:
        member = zlib.decompressobj(31)
        while content and not member.eof:
            yield member.decompress(content, READ_BYTES)
            content = member.unconsumed_tail or member.unused_data


def _record_row(headers: dict[str, str], block: bytes) -> tuple:
    http, _, payload = block.partition(b"\r\n\r\n")
    digest = headers.get("warc-payload-digest", "").removeprefix("sha1:")
    size, agrees = len(payload), None
    if headers["warc-type"] == "revisit":
        size = next((int(x.split(b":")[1]) for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:")), None)
    else:
        agrees = base64.b32encode(hashlib.sha1(payload).digest()).decode() == digest
    page = headers.get(PAGE_HEADER.lower())
    return (headers["warc-record-id"], headers["warc-type"], int(page) if page else None, headers.get("warc-target-uri"),
            digest, size, headers.get("warc-refers-to"), agrees)


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """One row per record of the archives below ``path``; a payload that contradicts its digest has ``digest_ok`` false."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path).select("content")
    schema = files.sparkSession.createDataFrame([], RECORD_COLUMNS).schema

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        shape = to_arrow_schema(schema)
        for batch in batches:
            for content in batch.column(0):
                rows = [_record_row(*record) for record in parse_records(_unzipped(content.as_py()))]
                columns = list(zip(*rows)) or [[]] * len(shape)
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, shape)], schema=shape)

    return files.mapInArrow(parse, schema)


def resolved(records: DataFrame) -> DataFrame:
    """``records`` with the ``refers_to`` page of each revisit, found by joining it to its response."""
    responses = (
        records.where("warc_type = 'response'").groupBy(F.col("record_id").alias("_id"))
        .agg(F.min("page_id").alias("refers_to"))
    )
    responses = written(responses, "responses")
    return records.join(responses, F.col("refers_to_record") == F.col("_id"), "left").drop("_id")


def archive_pages(pages: DataFrame, least_bytes: int = 0, path: str | None = None) -> DataFrame:
    """Write the archives, read them back and return the resolved records."""
    path = path or new_folder(pages.sparkSession, "warc")
    write_archives(pages, path, least_bytes)
    return resolved(read_archives(pages.sparkSession, path))
