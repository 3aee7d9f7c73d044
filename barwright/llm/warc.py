"""WARC archives with revisit records.

Pages with one payload of some size are stored once: the page with the largest id is the
response, the others become revisit records that name it.  Headers (id, digest, size) are
shuffled by digest; payloads are not.  Archives are ordinary gzipped WARC 1.1 files of whole
records, each with fresh headers: Spark's text writer with the record separator as its line
separator writes them, through whatever file system the path names.

Reading parses the files by Content-Length, checks each payload against its digest, and joins
revisit records to the originals they refer to."""

from __future__ import annotations

import hashlib
import zlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from barwright.llm.common import ship, staged

MIN_BYTES = 1000
FILE_BYTES = 32_000_000
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_SEPARATOR = "\r\n\r\n"


# --- deciding -----------------------------------------------------------------------


def resolve_revisits(pages: DataFrame, min_bytes: int = MIN_BYTES) -> DataFrame:
    """Add payload_bytes, payload_digest, record_type and refers_to to pages.

    A null html is an empty payload.  Payloads below ``min_bytes`` are always responses.  Rows
    that repeat a page_id with one payload have one fate.  A null page_id is no original while
    another page has the payload; where no page with the payload has an id, all are
    responses.  Columns of ``pages`` with the names of the added ones are replaced, others are kept;
    payloads of any length are hashed whole, and an empty table stays empty."""
    pages = pages.drop("record_type", "refers_to").withColumn("html", F.coalesce("html", F.lit("")))
    pages = pages.withColumn("payload_bytes", F.octet_length("html").cast("long"))
    pages = pages.withColumn("payload_digest", F.sha1(F.col("html").cast("binary")))
    large = F.col("payload_bytes") >= min_bytes
    # One header per digest leaves each task, however many copies it saw.
    originals = (
        pages.where(large)
        .groupBy("payload_digest", "payload_bytes")
        .agg(F.max("page_id").alias("__original"), F.count(F.lit(1)).alias("__copies"))
        .where("__copies > 1")
        .select("payload_digest", "payload_bytes", "__original")
    )
    # Written first, so Spark knows its size: a short list is sent to the pages, a long one is
    # joined by a shuffle in which adaptive execution splits a digest with very many pages.
    originals = staged(originals, "originals")
    joined = pages.join(originals, ["payload_digest", "payload_bytes"], "left")
    revisit = large & F.col("__original").isNotNull() & ~F.col("__original").eqNullSafe(F.col("page_id"))
    return joined.select(
        *pages.columns,
        F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        F.when(revisit, F.col("__original")).alias("refers_to"),
    )


# --- writing ------------------------------------------------------------------------


def _record_id(page_id: Column) -> Column:
    """A name made from the page id: the same page has the same name in each run."""
    h = F.md5(F.concat(F.lit("page "), F.coalesce(page_id.cast("string"), F.lit("none"))).cast("binary"))
    parts = [F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *parts), F.lit(">"))


def records(resolved: DataFrame, date: str) -> DataFrame:
    """The records as text, one column ``value``.  Line breaks in a url are percent-encoded;
    the page id travels in a header of its own."""
    url = F.regexp_replace(F.regexp_replace("url", "\r", "%0D"), "\n", "%0A")
    refers = F.col("refers_to").isNotNull()
    sha = F.concat(F.lit("sha1:"), F.col("payload_digest"))
    body = F.when(refers, F.lit("")).otherwise(F.col("html"))
    headers = F.concat_ws(
        "\r\n",
        F.lit("WARC/1.1"),
        F.concat(F.lit("WARC-Type: "), F.when(refers, "revisit").otherwise("response")),
        F.concat(F.lit("WARC-Record-ID: "), _record_id(F.col("page_id"))),
        F.concat(F.lit("WARC-Date: "), F.lit(date)),
        F.concat(F.lit("WARC-Target-URI: "), url),
        F.concat(F.lit("WARC-Page-ID: "), F.col("page_id").cast("string")),
        F.concat(F.lit("WARC-Payload-Digest: "), sha),
        F.when(refers, F.lit(f"WARC-Profile: {PROFILE}")),
        F.when(refers, F.concat(F.lit("WARC-Refers-To: "), _record_id(F.col("refers_to")))),
        F.when(refers, F.concat(F.lit("WARC-Refers-To-Page-ID: "), F.col("refers_to").cast("string"))),
        F.lit("Content-Type: text/html; charset=utf-8"),
        F.concat(F.lit("Content-Length: "), F.octet_length(body).cast("string")),
    )
    return resolved.select(F.concat(headers, F.lit(_SEPARATOR), body).alias("value"))


def write_archives(pages: DataFrame, path: str, date: str, min_bytes: int = MIN_BYTES) -> None:
    """Write gzipped archives of about ``FILE_BYTES`` of records each."""
    total = pages.agg(F.sum(F.octet_length("html"))).first()[0] or 0
    pages = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html")
    # Dealt once more as records, so that a large group of copies does not sit in one file.
    rows = records(resolve_revisits(pages, min_bytes), date).repartition(1 + total // FILE_BYTES)
    rows.write.option("lineSep", _SEPARATOR).option("compression", "gzip").text(path)


# --- reading ------------------------------------------------------------------------


def _parse(content: bytes):
    """Headers and body of each record of an unpacked archive."""
    at = 0
    while at < len(content):
        end = content.index(b"\r\n\r\n", at)
        lines = content[at:end].decode().split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"no WARC record at byte {at}")
        head = dict(line.split(": ", 1) for line in lines[1:])
        start = end + 4
        at = start + int(head["Content-Length"])
        yield head, content[start:at]
        at += 4


def read_archives(spark: SparkSession, path: str, with_html: bool = True) -> DataFrame:
    """The records of the archives: page_id, url, record_type, payload_digest (of the full
    payload), refers_to, content_bytes (of the record), and html unless not wanted.  A response
    whose payload does not fit its digest stops the read."""
    ship(spark)

    def parse(batches):
        for batch in batches:
            for packed in batch.column("content"):
                rows = []
                for head, body in _parse(zlib.decompress(packed.as_buffer(), 31)):
                    digest = head["WARC-Payload-Digest"].removeprefix("sha1:")
                    kind = head["WARC-Type"]
                    if kind == "response" and hashlib.sha1(body).hexdigest() != digest:
                        raise ValueError(f"payload of {head['WARC-Record-ID']} does not fit its digest")
                    page, to = head.get("WARC-Page-ID"), head.get("WARC-Refers-To-Page-ID")
                    row = (page and int(page), head.get("WARC-Target-URI"), kind, digest, to and int(to), len(body))
                    rows.append((*row, body.decode()) if with_html else row)
                names = ["page_id", "url", "record_type", "payload_digest", "refers_to", "content_bytes", "html"]
                kinds = [pa.int64(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string()]
                for i in range(0, len(rows), 2000):
                    columns = zip(*rows[i : i + 2000], strict=True)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, k) for c, k in zip(columns, kinds, strict=False)], names[: len(rows[0])]
                    )

    schema = "page_id long, url string, record_type string, payload_digest string, refers_to long, content_bytes long"
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path).select("content")
    return files.mapInArrow(parse, schema + (", html string" if with_html else ""))


def with_originals(rows: DataFrame, columns: tuple[str, ...] = ("content_bytes",)) -> DataFrame:
    """Give revisit records the named columns of the response they refer to; that response
    also has to have their digest.  The many revisits of one page are a skewed key with one
    row on the other side, which adaptive execution splits."""
    responses = rows.where("record_type = 'response'").select(
        F.col("page_id").alias("refers_to"), F.col("payload_digest").alias("payload_digest"),
        *[F.col(c).alias(f"__{c}") for c in columns],
    )
    responses = responses.where("refers_to IS NOT NULL").dropDuplicates(["refers_to", "payload_digest"])
    keep = [c for c in rows.columns if c not in columns]
    visits = rows.where("record_type = 'revisit'").join(responses, ["refers_to", "payload_digest"], "left")
    visits = visits.select(*keep, *[F.col(f"__{c}").alias(c) for c in columns])
    return rows.where("record_type = 'response'").select(*keep, *columns).unionByName(visits)
