"""Content-addressed WARC archive: payload bytes once by verified digest, headers kept apart.

``write_archive`` stores two tables: ``payloads`` (digest, payload) holds each distinct payload once,
``headers`` (page_id, url, digest, header) holds the exact header block of every record.
``records`` joins them back to the original records.  Columns and SQL functions only.

A revisit's block is empty (its payload is that of the record it refers to), so its Content-Length is 0.
A line end in a url is percent-encoded in its header line; the ``url`` column keeps the url as it came.

Defined results: a null payload is the empty payload; a null page_id is written with an empty record
number and is never the response that others refer to unless all its copies have none; repeated rows
are records of their own, of which one per payload (smallest page_id) is the response and rows with
that same page_id are all responses; an empty table gives an empty archive; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import fresh_path

#: Payloads shorter than this are always stored with a response record.
REVISIT_MIN_BYTES = 100

CRLF = "\r\n"


#: The profile of a record whose payload is that of an earlier one.
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def _header(kind: Column, refers: Column, date: str) -> Column:
    """The header block of a record; optional lines are left out, not left empty."""

    def line(name: str, value: Column) -> Column:
        return F.concat(F.lit(f"{name}: "), value, F.lit(CRLF))

    revisit = kind == "revisit"
    uri = F.replace(F.replace(F.col("url"), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    return F.concat(
        F.lit(f"WARC/1.1{CRLF}"),
        line("WARC-Type", kind),
        line("WARC-Record-ID", F.concat(F.lit("<urn:page:"), F.coalesce(F.col("page_id").cast("string"), F.lit("")), F.lit(">"))),
        F.lit(f"WARC-Date: {date}{CRLF}"),
        F.coalesce(line("WARC-Target-URI", uri), F.lit("")),
        F.when(revisit, F.lit(f"WARC-Profile: {PROFILE}{CRLF}")).otherwise(""),
        F.coalesce(line("WARC-Refers-To", F.concat(F.lit("<urn:page:"), refers.cast("string"), F.lit(">"))), F.lit("")),
        line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("digest"))),
        F.lit(f"Content-Type: text/html; charset=utf-8{CRLF}"),
        line("Content-Length", F.when(revisit, "0").otherwise(F.col("bytes").cast("string"))),
    )


def write_archive(pages: DataFrame, path: str, min_bytes: int = REVISIT_MIN_BYTES, date: str = "1970-01-01T00:00:00Z") -> None:
    """Writes ``pages`` (page_id, url, html) as an archive of two Parquet tables under ``path``.

    ``date``: when the pages were fetched, which they don't say themselves.

    One shuffle of payloads: the copies of a payload are reduced before and after it, so that many
    copies cost one row for each task.  The headers' shuffle moves digests and urls only.
    """
    spark = pages.sparkSession
    payload = F.encode(F.coalesce(F.col("html"), F.lit("")), "utf-8")
    src = pages.select("page_id", "url", payload.alias("payload"))
    keyed = src.select("page_id", "payload", F.sha2("payload", 256).alias("digest"))
    store = keyed.groupBy("digest").agg(F.min("page_id").alias("first_id"), F.first("payload").alias("payload"))
    store.write.parquet(f"{path}/payloads")

    first = spark.read.parquet(f"{path}/payloads").select("digest", "first_id")
    rows = src.select("page_id", "url", F.sha2("payload", 256).alias("digest"), F.octet_length("payload").cast("long").alias("bytes"))
    rows = rows.join(first, "digest", "left")
    revisit = (F.col("bytes") >= min_bytes) & (F.col("page_id") != F.col("first_id"))
    revisit = F.coalesce(revisit, F.col("page_id").isNull() & F.col("first_id").isNotNull() & (F.col("bytes") >= min_bytes))
    headers = rows.select(
        "page_id",
        "url",
        "digest",
        _header(F.when(revisit, "revisit").otherwise("response"), F.when(revisit, F.col("first_id")), date).alias("header"),
    )
    headers.write.parquet(f"{path}/headers")


def _field(name: str) -> Column:
    value = F.regexp_extract("header", rf"(?:^|\r\n){name}: ([^\r\n]*)", 1)
    return F.when(value != "", value)


def read_headers(spark: SparkSession, path: str) -> DataFrame:
    """Headers parsed from their blocks: page_id, url, digest, header, record_type, refers_to, block_bytes."""
    number = lambda c: F.regexp_extract(c, r"<urn:page:(-?\d+)>", 1).try_cast("long")
    return spark.read.parquet(f"{path}/headers").select(
        number(_field("WARC-Record-ID")).alias("page_id"),
        "url",
        F.regexp_replace(_field("WARC-Payload-Digest"), "^sha256:", "").alias("digest"),
        "header",
        _field("WARC-Type").alias("record_type"),
        number(_field("WARC-Refers-To")).alias("refers_to"),
        _field("Content-Length").try_cast("long").alias("block_bytes"),
    )


def verified_payloads(spark: SparkSession, path: str) -> DataFrame:
    """Payloads with the digest taken anew from their bytes; a mismatch fails the read."""
    got = F.sha2("payload", 256)
    checked = F.when(got == F.col("digest"), got).otherwise(F.raise_error(F.concat(F.lit("payload does not match its digest "), F.col("digest"))))
    return spark.read.parquet(f"{path}/payloads").select(checked.alias("digest"), "payload", F.octet_length("payload").cast("long").alias("payload_bytes"))


def records(spark: SparkSession, path: str) -> DataFrame:
    """The original records: parsed headers joined with the stored payloads.

    ``record`` is the WARC record, byte for byte: header block, blank line, payload, two line ends.
    A revisit record carries no payload of its own; ``payload`` still gives the page's bytes.
    """
    crlf = F.encode(F.lit(CRLF), "utf-8")
    body = F.when(F.col("record_type") == "revisit", F.encode(F.lit(""), "utf-8")).otherwise(F.col("payload"))
    both = read_headers(spark, path).join(verified_payloads(spark, path), "digest", "left")
    return both.withColumn("record", F.concat(F.encode("header", "utf-8"), crlf, body, crlf, crlf))


def archive_pages(pages: DataFrame) -> DataFrame:
    """Writes an archive of ``pages`` in the shared folder and returns what reading it back gives.

    page_id, payload_bytes, payload_digest (from the stored bytes), record_type, refers_to.  The join
    is ``records``' own; as no column needs the bytes beyond their scan, they stay out of its shuffle.
    """
    spark = pages.sparkSession
    path = fresh_path(spark, "warc")
    write_archive(pages, path)
    return records(spark, path).select("page_id", "payload_bytes", F.col("digest").alias("payload_digest"), "record_type", "refers_to")
