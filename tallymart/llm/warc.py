"""WARC archives with revisit records in place of repeated payloads.

Headers, without payloads, are shuffled by payload digest; each digest's original is the record with
the smallest id, and the other records of that digest become revisits that refer to it. Fresh
archives are written with new record headers and read back.

A record is an HTTP response with its header block. A revisit keeps the header block, whose
Content-Length states the full payload, and leaves the payload out. It names its original by record id and by URL. Record ids are
made of digest and page id, so an original's id is known wherever its digest is. Every header gets the time of writing, unless
a date is given. Archives are text files whose records end with the two line ends that the format asks for; ``gzip`` compresses
whole files, as a text sink cannot begin a new gzip member for each record.

Edge cases: a page must stay under the 2 GB that one value can hold. A null payload is empty. Payloads under ``least`` bytes are always responses. Repeated
rows of the smallest id are all responses. A null id counts as larger than any other; where all ids of
a digest are null, all are responses. Line ends and blanks in a URL are percent-encoded, a null URL
leaves the header out. An empty table writes no record. Extra columns are ignored.
"""

from __future__ import annotations

import gzip
import hashlib
import io
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import stored

#: Payload bytes that go to one archive file.
FILE_BYTES = 16 << 20
#: Originals of repeated digests that are broadcast, about 100 bytes each besides their URLs, and bytes of these; more are shuffled.
BROADCAST_ROWS = 200_000
BROADCAST_BYTES = 16 << 20
#: Smaller payloads are not worth a revisit record.
LEAST = 100
#: Rows of one Arrow batch while reading.
_ROWS = 5000
_END = "\r\n\r\n"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HEADERS = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, refers_to_url string"


def headers(pages: DataFrame) -> DataFrame:
    """(page_id, url, html, payload_bytes, payload_digest) of every page."""
    payload = F.encode(F.coalesce(F.col("html"), F.lit("")), "UTF-8")
    return pages.select(
        "page_id", "url", F.coalesce(F.col("html"), F.lit("")).alias("html"),
        F.octet_length(payload).cast("long").alias("payload_bytes"), F.sha2(payload, 256).alias("payload_digest"),
    )


def originals(records: DataFrame, least: int = LEAST) -> DataFrame:
    """The record that each repeated digest refers to, and its URL; digests seen once need none."""
    known = F.when(F.col("page_id").isNotNull(), F.struct("page_id", "url"))
    return (
        records.where(F.col("payload_bytes") >= least).groupBy("payload_digest")
        .agg(F.min(known).alias("first"), F.count("*").alias("n")).where("n > 1")
        .select("payload_digest", F.col("first.page_id").alias("original"), F.col("first.url").alias("original_url"))
    )


def resolve(records: DataFrame, least: int = LEAST) -> DataFrame:
    """Add record_type, refers_to and refers_to_url.

    Few originals are broadcast, and payloads stay where they are. Else both sides are shuffled by digest;
    a hot digest is one row on the originals' side, so its partition can be split.
    """
    known = stored(originals(records, least), "originals")
    n, url_bytes = known.agg(F.count("*"), F.sum(F.octet_length("original_url"))).first()
    if n <= BROADCAST_ROWS and (url_bytes or 0) <= BROADCAST_BYTES:
        known = F.broadcast(known)
    repeats = (F.col("original").isNotNull()) & ~F.col("page_id").eqNullSafe(F.col("original"))
    return records.join(known, "payload_digest", "left").withColumns({
        "record_type": F.when(repeats, "revisit").otherwise("response"),
        "refers_to": F.when(repeats, F.col("original")),
        "refers_to_url": F.when(repeats, F.col("original_url")),
    }).drop("original", "original_url")


def _record_id(page_id: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), F.left("payload_digest", F.lit(32)), F.lit(":"), F.coalesce(page_id.cast("string"), F.lit("unknown")), F.lit(">"))


def _uri(url: Column) -> Column:
    """A URL that fits a header line."""
    for char, code in ((" ", "%20"), ("\t", "%09"), ("\r", "%0D"), ("\n", "%0A")):
        url = F.replace(url, F.lit(char), F.lit(code))
    return url


def _line(name: str, value: Column) -> Column:
    """A header line; no line where the value is null."""
    return F.coalesce(F.concat(F.lit(f"\r\n{name}: "), value.cast("string")), F.lit(""))


def record(date: str | None = None) -> Column:
    """The whole record as text, without its closing line ends; ``date`` is the time of the query by default."""
    now = F.date_format(F.convert_timezone(None, F.lit("UTC"), F.current_timestamp().cast("timestamp_ntz")), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    revisit = F.col("record_type") == "revisit"
    http = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8"),
        _line("Content-Length", F.col("payload_bytes")), F.lit(_END),
    )
    length = F.octet_length(http) + F.when(revisit, 0).otherwise(F.col("payload_bytes"))
    return F.concat(
        F.lit("WARC/1.1"),
        _line("WARC-Type", F.col("record_type")), _line("WARC-Record-ID", _record_id(F.col("page_id"))),
        _line("WARC-Date", F.lit(date) if date else now), _line("WARC-Target-URI", _uri(F.col("url"))),
        _line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("payload_digest"))),
        _line("WARC-Profile", F.when(revisit, _PROFILE)),
        _line("WARC-Refers-To", F.when(revisit, _record_id(F.col("refers_to")))),
        _line("WARC-Refers-To-Target-URI", _uri(F.col("refers_to_url"))),
        _line("Content-Type", F.lit("application/http; msgtype=response")), _line("Content-Length", length),
        F.lit(_END), http, F.when(revisit, "").otherwise(F.col("html")),
    )


def write_archives(resolved: DataFrame, path: str, files: int, date: str | None = None) -> None:
    """Write records into about ``files`` archives of even size; records are dealt by a hash of their headers."""
    (
        resolved.repartition(files, F.xxhash64("page_id", "url", "payload_digest")).select(record(date).alias("value"))
        .write.option("lineSep", _END).option("compression", "gzip").text(path)
    )


def _head(stream: io.BufferedIOBase) -> dict[str, str] | None:
    """Header lines up to the blank line, by lower-case name; None at the end of the file."""
    first = stream.readline()
    if not first:
        return None
    found = {"": first.decode().strip()}
    while (line := stream.readline().decode().rstrip("\r\n")):
        name, _, value = line.partition(": ")
        found[name.lower()] = value
    return found


def _page(record_id: str | None) -> int | None:
    tail = (record_id or "").rstrip(">").rpartition(":")[2]
    return int(tail) if tail.lstrip("-").isdigit() else None


def _records(content: bytes) -> Iterator[tuple]:
    """What ``HEADERS`` lists of each record of one archive; a response's payload is checked against its digest."""
    with gzip.open(io.BytesIO(content)) as stream:
        while (head := _head(stream)) is not None:
            block = stream.read(int(head["content-length"]))
            http = _head(inner := io.BytesIO(block))
            digest = head["warc-payload-digest"].partition(":")[2]
            if head["warc-type"] == "response" and hashlib.sha256(memoryview(block)[inner.tell():]).hexdigest() != digest:
                raise ValueError(f"payload of {head['warc-record-id']} does not match its digest")
            if stream.read(4) != b"\r\n\r\n":
                raise ValueError(f"record {head['warc-record-id']} is cut off")
            yield (_page(head["warc-record-id"]), head.get("warc-target-uri"), int(http["content-length"]), digest,
                   head["warc-type"], _page(head.get("warc-refers-to")), head.get("warc-refers-to-target-uri"))


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [part.split()[0] for part in HEADERS.split(", ")]
    types = [pa.string() if part.endswith("string") else pa.int64() for part in HEADERS.split(", ")]

    def packed(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)

    for batch in batches:
        for content in batch.column(0):
            rows: list[tuple] = []
            for row in _records(content.as_py()):
                rows.append(row)
                if len(rows) == _ROWS:
                    yield packed(rows)
                    rows = []
            if rows:
                yield packed(rows)


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """Headers of all records below a folder. Each task holds one archive file at a time."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path)
    return files.select("content").mapInArrow(_read, HEADERS)


def deduplicate(pages: DataFrame, path: str, least: int = LEAST) -> DataFrame:
    """Write deduplicated archives of ``pages`` below ``path`` and return what they hold."""
    records = headers(pages)
    total = pages.agg(F.sum(F.octet_length("html"))).first()[0] or 0
    write_archives(resolve(records, least), path, int(total // FILE_BYTES) + 1)
    return read_archives(pages.sparkSession, path)


def digest(archived: DataFrame) -> DataFrame:
    return archived.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


#: What ``digest`` returns, from the raw pages.
SQL = f"""
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS body FROM pages),
h AS (SELECT page_id, octet_length(body)::BIGINT AS payload_bytes, sha256(body) AS payload_digest FROM p),
o AS (SELECT payload_digest, min(page_id) AS original FROM h WHERE payload_bytes >= {LEAST} GROUP BY 1)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN original IS NOT NULL AND page_id IS DISTINCT FROM original THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id IS DISTINCT FROM original THEN original END AS refers_to
FROM h LEFT JOIN o USING (payload_digest)
"""
