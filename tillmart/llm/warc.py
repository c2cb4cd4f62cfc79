"""WARC archives with revisit records for payloads that another record holds.

Defined results: a null payload is empty and a null address is left out of the
headers. Of the records with equal payloads that with the largest id is the
response; rows that repeat that id are responses, too. A null id is never the
response that others refer to. Line breaks in an address are percent-encoded.
Other columns are not read. An empty table gives an archive without records.
"""

import gzip
import hashlib
import io
from base64 import b32encode
from collections.abc import Iterator
from datetime import datetime, timezone

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tillmart.llm.common import base32_of_hex, text_of
from tillmart.session import written

#: Fixed texts of the format.
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
END = "\r\n\r\n"
ARCHIVE_BYTES = 64 << 20
READ = (
    "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long,"
    "url string, block_bytes long, intact boolean"
)


def records(pages: DataFrame, *, page_id: str = "page_id", url: str = "url", payload: str = "html") -> DataFrame:
    body = text_of(payload)
    return pages.select(
        F.col(page_id).cast("long").alias("page_id"),
        F.col(url).cast("string").alias("url"),
        body.alias("payload"),
        F.octet_length(body).cast("long").alias("payload_bytes"),
        base32_of_hex(F.sha1(body.cast("binary"))).alias("payload_digest"),
    )


def originals(headers: DataFrame, least_bytes: int) -> DataFrame:
    """The response of each payload that several records hold; only headers are shuffled.

    Written, so that the planner sees the size and can split a payload's many records.
    """
    shared = (
        headers.filter(F.col("payload_bytes") >= least_bytes)
        .groupBy("payload_digest", "payload_bytes")
        .agg(F.max("page_id").alias("original"), F.max_by("url", "page_id").alias("original_url"), F.count("*").alias("copies"))
        .filter((F.col("copies") > 1) & F.col("original").isNotNull())
        .drop("copies")
    )
    return written(shared, "warc_originals")


def resolve(found: DataFrame, headers: DataFrame, least_bytes: int = 0) -> DataFrame:
    """Adds ``record_type`` and ``refers_to``: revisits refer to the response with their payload."""
    joined = found.join(originals(headers, least_bytes), ["payload_digest", "payload_bytes"], "left")
    revisit = F.col("original").isNotNull() & ~F.col("original").eqNullSafe(F.col("page_id"))
    return joined.withColumns(
        {
            "record_type": F.when(revisit, "revisit").otherwise("response"),
            "refers_to": F.when(revisit, F.col("original")),
            "original_url": F.when(revisit, F.col("original_url")),
        }
    ).drop("original")


def _line(name: str, value: Column) -> Column:
    """A header line, or nothing if the value is null."""
    return F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit("\r\n")), F.lit(""))


def _address(url: Column) -> Column:
    return F.replace(F.replace(url, F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))


def _record_id(page_id: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), F.coalesce(page_id.cast("string"), F.lit("none")), F.lit(">"))


def record_text(date: str) -> Column:
    """The whole record with fresh headers, but for the two line breaks that end it."""
    revisit = F.col("record_type") == "revisit"
    http = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
        F.col("payload_bytes").cast("string"),
        F.lit(END),
    )
    block = F.concat(http, F.when(revisit, F.lit("")).otherwise(F.col("payload")))
    return F.concat(
        F.lit("WARC/1.1\r\n"),
        _line("WARC-Type", F.col("record_type")),
        _line("WARC-Record-ID", _record_id(F.col("page_id"))),
        _line("WARC-Date", F.lit(date)),
        _line("WARC-Target-URI", _address(F.col("url"))),
        _line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("payload_digest"))),
        _line("X-Payload-Length", F.col("payload_bytes").cast("string")),
        _line("WARC-Block-Digest", F.concat(F.lit("sha1:"), base32_of_hex(F.sha1(block.cast("binary"))))),
        _line("WARC-Profile", F.when(revisit, F.lit(PROFILE))),
        _line("WARC-Refers-To", F.when(revisit, _record_id(F.col("refers_to")))),
        _line("WARC-Refers-To-Target-URI", F.when(revisit, _address(F.col("original_url")))),
        _line("WARC-Refers-To-Date", F.when(revisit, F.lit(date))),
        F.lit("Content-Type: application/http; msgtype=response\r\nContent-Length: "),
        F.octet_length(block).cast("string"),
        F.lit(END),
        block,
    )


def write_archives(pages: DataFrame, path: str, *, least_bytes: int = 0, date: str | None = None, **columns: str) -> None:
    """Gzipped archives of about ``ARCHIVE_BYTES`` before compression, written by Spark's own writer.

    A record is a row that ends in two line breaks, which is what the format asks for.
    ``columns`` names the id, address and payload columns, see ``records``.
    """
    date = date or datetime.now(timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")
    found = records(pages, **columns)
    headers = written(found.drop("payload"), "warc_headers")
    mean = headers.agg(F.avg("payload_bytes").alias("mean")).first()["mean"] or 0
    per_file = max(1, int(ARCHIVE_BYTES / (mean + 800)))
    resolve(found, headers, least_bytes).select(record_text(date).alias("value")).write.option("maxRecordsPerFile", per_file).text(path, compression="gzip", lineSep=END)


def _records_in(content: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers and block of each record, by the stated lengths."""
    with gzip.GzipFile(fileobj=io.BytesIO(content)) as archive:
        while version := archive.readline():
            if not version.startswith(b"WARC/"):
                raise ValueError(f"no record where one should begin: {version[:40]!r}")
            headers = {}
            while (line := archive.readline().rstrip(b"\r\n")):
                name, _, value = line.decode("utf-8").partition(": ")
                headers[name] = value
            yield headers, archive.read(int(headers["Content-Length"]))
            if archive.read(len(END)) != END.encode():
                raise ValueError("a record does not end in two line breaks")


def _digest(content: bytes) -> str:
    return b32encode(hashlib.sha1(content).digest()).decode()


def _page_of(record_id: str | None) -> int | None:
    number = (record_id or "").removeprefix("<urn:page:").removesuffix(">")
    return int(number) if number not in ("", "none") else None


def _row(headers: dict[str, str], block: bytes) -> tuple:
    payload = block.split(END.encode(), 1)[1]
    kind, digest = headers["WARC-Type"], headers["WARC-Payload-Digest"].removeprefix("sha1:")
    intact = headers["WARC-Block-Digest"] == f"sha1:{_digest(block)}"
    length = int(headers["X-Payload-Length"])
    if kind == "response":
        digest, length, intact = _digest(payload), len(payload), intact and digest == _digest(payload)
    return (
        _page_of(headers["WARC-Record-ID"]),
        length,
        digest,
        kind,
        _page_of(headers.get("WARC-Refers-To")),
        headers.get("WARC-Target-URI"),
        len(block),
        intact,
    )


def _parse(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    names = [part.split()[0] for part in READ.split(",")]
    for frame in frames:
        for content in frame["content"]:
            rows = [_row(*record) for record in _records_in(content)]
            out = pd.DataFrame(rows, columns=names)
            yield out.astype({"page_id": "Int64", "refers_to": "Int64"})


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """One row per record: a response's length and digest are worked out from its payload, a revisit's read."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("content")
    return files.mapInPandas(_parse, READ)
