"""Content-addressed WARC archive.

The archive is two tables. ``payloads`` holds each distinct payload once, under its SHA-256;
``headers`` holds the exact header bytes of every record and the digest of its payload. Reading
joins them, so each original record comes back whole, revisits included.

Copies meet on their digest with a map-side aggregate, so a payload that a third of all records
share is shuffled once per map task, and the joins on digests carry no payload unless asked for.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from civiclens.llm.common import Scratch, table, utf8

col = F.col

# Fixed values of the WARC format and of RFC 4648.
VERSION = "WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RADIX_32 = "0123456789ABCDEFGHIJKLMNOPQRSTUV"
BASE_32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"

NO_DATE = "1970-01-01T00:00:00Z"


def base32_sha1(payload: Column) -> Column:
    """SHA-1 in upper-case base32: every five hex digits are four base32 digits."""
    digits = F.sha1(payload)
    groups = [
        F.lpad(F.conv(F.substring(digits, 5 * i + 1, 5), 16, 32), 4, "0") for i in range(8)
    ]
    return F.translate(F.concat(*groups), RADIX_32, BASE_32)


def _header(id_column: str, uri: str, date: str) -> Column:
    """Header block of a record; a URI's line breaks are percent-encoded, a NULL URI has no line."""
    name = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(c.cast("string"), F.lit("")), F.lit(">"))
    uri_text = F.replace(F.replace(col(uri), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    lines = [
        F.lit(VERSION),
        F.concat(F.lit("WARC-Type: "), col("record_type")),
        F.concat(F.lit("WARC-Record-ID: "), name(col(id_column))),
        F.lit(f"WARC-Date: {date}"),
        F.concat(F.lit("WARC-Target-URI: "), uri_text),
        F.concat(F.lit("WARC-Payload-Digest: sha1:"), col("payload_digest")),
        F.when(col("record_type") == "revisit", F.concat(F.lit("WARC-Refers-To: "), name(col("refers_to")))),
        F.when(col("record_type") == "revisit", F.lit(f"WARC-Profile: {REVISIT_PROFILE}")),
        F.lit("Content-Type: text/html"),
        F.concat(
            F.lit("Content-Length: "),
            F.when(col("record_type") == "revisit", F.lit(0)).otherwise(col("payload_bytes")).cast("string"),
        ),
        F.lit("\r\n"),
    ]
    return F.concat_ws("\r\n", *lines).cast("binary")


def write_archive(
    pages: DataFrame,
    folder: str,
    id_column: str = "page_id",
    uri: str = "url",
    body: str = "html",
    min_bytes: int = 0,
    date: str = NO_DATE,
) -> None:
    """Write one record per row below ``folder``.

    Of records with equal payloads of at least ``min_bytes`` bytes the one with the largest id is
    the response and the others revisit it; shorter payloads are all responses. A NULL body is
    the empty payload. A NULL id is smaller than any other. Rows that repeat an id and a payload
    are the same record twice and get the same type. Other columns are ignored.
    """
    spark = pages.sparkSession
    bodies = pages.select(
        col(id_column).alias("page_id"), F.col(uri).alias("url"), utf8(body).alias("payload")
    )
    addressed = bodies.withColumn("digest", F.unhex(F.sha2("payload", 256)))
    size = F.length("payload").cast("long")
    stored = (
        addressed.groupBy("digest")
        .agg(
            F.first("payload").alias("payload"),
            F.max("page_id").alias("response_id"),
            F.min(size).alias("least"),
            F.max(size).alias("payload_bytes"),
        )
        .withColumn(
            "payload_bytes",
            F.when(col("least") == col("payload_bytes"), col("payload_bytes")).otherwise(
                F.raise_error(F.lit("two payloads share a SHA-256 digest"))
            ),
        )
        .withColumn("payload_digest", base32_sha1(col("payload")))
        .select("digest", "payload_digest", "payload_bytes", "response_id", "payload")
    )
    stored.write.mode("overwrite").parquet(f"{folder}/payloads")

    index = spark.read.parquet(f"{folder}/payloads").drop("payload")
    first = (col("payload_bytes") < min_bytes) | col("page_id").eqNullSafe(col("response_id"))
    records = (
        addressed.select("page_id", "url", "digest")
        .join(index, "digest")
        .withColumn("record_type", F.when(first, "response").otherwise("revisit"))
        .withColumn("refers_to", F.when(~first, col("response_id")))
    )
    headers = records.select("page_id", "digest", _header("page_id", "url", date).alias("header"))
    headers.write.mode("overwrite").parquet(f"{folder}/headers")


def _field(name: str) -> Column:
    """Value of a header line, '' if the record has no such line."""
    return F.regexp_extract(F.decode("header", "UTF-8"), rf"\r\n{name}: ([^\r]*)\r\n", 1)


def read_archive(spark: SparkSession, folder: str) -> DataFrame:
    """Original records: id, header fields, header bytes and the whole payload.

    Each payload's SHA-256 and SHA-1 are computed again from the stored bytes; a payload that no
    longer has its digest, or a header that names another, ends the job.
    """
    checked = spark.read.parquet(f"{folder}/payloads").select(
        F.when(F.unhex(F.sha2("payload", 256)) == col("digest"), col("digest"))
        .otherwise(F.raise_error(F.lit("a stored payload does not have its digest")))
        .alias("digest"),
        base32_sha1(col("payload")).alias("actual"),
        F.length("payload").cast("long").alias("payload_bytes"),
        "payload",
    )
    headers = spark.read.parquet(f"{folder}/headers").select(
        "page_id",
        "digest",
        "header",
        _field("WARC-Type").alias("record_type"),
        F.regexp_extract(_field("WARC-Refers-To"), r"<urn:page:(-?\d+)>", 1).try_cast("long").alias("refers_to"),
        F.substring_index(_field("WARC-Payload-Digest"), ":", -1).alias("declared"),
    )
    return headers.join(checked, "digest").select(
        "page_id",
        "payload_bytes",
        F.when(col("declared") == col("actual"), col("actual"))
        .otherwise(F.raise_error(F.lit("a record's digest is not its payload's")))
        .alias("payload_digest"),
        "record_type",
        "refers_to",
        "header",
        "payload",
    )


def record_bytes() -> Column:
    """A record as it stands in a WARC file: a revisit carries its header block only."""
    block = F.when(col("record_type") == "revisit", F.lit(b"")).otherwise(col("payload"))
    return F.concat(col("header"), block, F.lit(b"\r\n\r\n"))


def op2_warc_archive(spark: SparkSession, folder: str) -> DataFrame:
    """Archive every page, read the archive back, report each record."""
    archive = f"{Scratch(spark, 'warc').root}/archive"
    write_archive(table(spark, folder, "pages"), archive)
    return read_archive(spark, archive).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


ORACLE = """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS body FROM pages
), d AS (
  SELECT page_id, strlen(body) AS payload_bytes, sha1(body) AS h, max(page_id) OVER (PARTITION BY body) AS newest
  FROM p
)
SELECT page_id, payload_bytes,
       array_to_string([translate(to_base(('0x' || h[5 * i + 1 : 5 * i + 5])::BIGINT, 32, 4),
         '0123456789ABCDEFGHIJKLMNOPQRSTUV', 'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567') FOR i IN range(8)], '') AS payload_digest,
       CASE WHEN page_id IS NOT DISTINCT FROM newest THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id IS DISTINCT FROM newest THEN newest END AS refers_to
FROM d
"""
