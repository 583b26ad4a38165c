"""Operator 8: a content-addressed WARC archive.

``write_archive`` stores every distinct payload once, under its SHA-256, and the exact record headers apart from it.
``read_records``, ``read_payloads`` and ``restore`` read the archive back; ``restore`` joins header and payload to the
original record. Both parts are Parquet tables, so the payload of a record that is only asked for its header is not read.

Defined cases: a null payload is an empty one; empty payloads are payloads like others. A null URL gives no
``WARC-Target-URI``. Among equal payloads the largest id is the response; repeated rows with that id are responses too. Rows
without an id are revisits of the response, or responses if no row of the group has an id. Line breaks inside a URL are
percent-encoded, so they cannot end a header. Other columns of the input are ignored. An empty table gives an empty archive.

A payload is shuffled once, for its group; copies are combined inside each task before, so one group of copies is no hot key.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import shared_dir, table

#: RFC 4648 alphabet and WARC revisit profile, fixed values.
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORD_DATE = "2025-01-01T00:00:00Z"


def sha1_base32(payload: Column) -> Column:
    """Bare upper-case base32 of the SHA-1: 160 bits, read as four numbers of 40 bits."""
    digits = F.sha1(payload)
    letters = []
    for start in range(1, 41, 10):
        number = F.conv(F.substring(digits, start, 10), 16, 10).cast("long")
        for shift in range(35, -1, -5):
            index = F.shiftright(number, shift).bitwiseAND(F.lit(31)).cast("int")
            letters.append(F.substring(F.lit(BASE32), index + 1, F.lit(1)))
    return F.concat(*letters)


def _rows(pages: DataFrame, page_id: str, url: str, payload: str) -> DataFrame:
    body = F.coalesce(pages[payload].cast("string").cast("binary"), F.lit(b""))
    return pages.select(
        pages[page_id].cast("long").alias("page_id"), pages[url].cast("string").alias("url"), body.alias("payload")
    ).withColumn("digest", F.unhex(F.sha2("payload", 256)))


def _record_uri(page_id: Column) -> Column:
    return F.concat(F.lit("<urn:x-page:"), F.coalesce(page_id.cast("string"), F.lit("none")), F.lit(">"))


def _header(first_response: Column, revisit: Column) -> Column:
    def field(name: str, value: Column) -> Column:
        return F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))

    uri = F.replace(F.replace(F.col("url"), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    length = F.when(revisit, F.lit(0)).otherwise(F.col("payload_bytes"))
    return F.concat(
        F.lit("WARC/1.1\r\n"),
        field("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        field("WARC-Record-ID", _record_uri(F.col("page_id"))),
        F.coalesce(field("WARC-Target-URI", uri), F.lit("")),
        field("WARC-Date", F.lit(RECORD_DATE)),
        field("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("sha1"))),
        F.when(
            revisit,
            F.concat(field("WARC-Refers-To", _record_uri(first_response)), field("WARC-Profile", F.lit(REVISIT_PROFILE))),
        ).otherwise(""),
        field("Content-Type", F.lit("text/html; charset=utf-8")),
        field("Content-Length", length.cast("string")),
        F.lit("\r\n"),
    ).cast("binary")


def write_archive(
    pages: DataFrame, path: str, page_id: str = "page_id", url: str = "url", payload: str = "html", min_bytes: int = 0
) -> None:
    """Write ``path``/payloads (digest, response_id, payload) and ``path``/records (header, digest).

    Equal digests are held against a second, independent fingerprint and the length; a mismatch fails the job.
    """
    spark = pages.sparkSession
    rows = _rows(pages, page_id, url, payload)
    print_2 = F.struct(F.xxhash64("payload").alias("h"), F.length("payload").alias("n"))
    stored = (
        rows.groupBy("digest")
        .agg(
            F.max("page_id").alias("response_id"),
            F.first("payload").alias("payload"),
            F.min(print_2).alias("least"),
            F.max(print_2).alias("most"),
        )
        .withColumn("payload", F.when(F.col("least") == F.col("most"), F.col("payload")).otherwise(F.raise_error(F.lit("two payloads with one digest")).cast("binary")))
    )
    stored.select("digest", "response_id", "payload").write.option("compression", "zstd").parquet(f"{path}/payloads")
    facts = rows.select(
        "page_id", "url", "digest", sha1_base32(F.col("payload")).alias("sha1"), F.length("payload").cast("long").alias("payload_bytes")
    )
    owner = spark.read.parquet(f"{path}/payloads").select("digest", "response_id")
    own = F.col("response_id").isNull() | F.col("page_id").eqNullSafe(F.col("response_id"))
    revisit = ~own & (F.col("payload_bytes") >= min_bytes)
    records = facts.join(owner, "digest").select(_header(F.col("response_id"), revisit).alias("header"), "digest")
    records.write.option("compression", "zstd").parquet(f"{path}/records")


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """One row per record: its header, the fields read from it, and the digest of its payload."""
    records = spark.read.parquet(f"{path}/records")
    text = F.col("header").cast("string")

    def value(name: str) -> Column:
        return F.nullif(F.regexp_extract(text, rf"\r\n{name}: ([^\r]*)\r\n", 1), F.lit(""))

    def page(uri: Column) -> Column:
        return F.regexp_extract(uri, "^<urn:x-page:(.*)>$", 1).try_cast("long")

    return records.select(
        page(value("WARC-Record-ID")).alias("page_id"),
        value("WARC-Type").alias("record_type"),
        value("WARC-Target-URI").alias("url"),
        page(value("WARC-Refers-To")).alias("refers_to"),
        F.substring(value("WARC-Payload-Digest"), 6, 32).alias("header_digest"),
        "header",
        "digest",
    )


def read_payloads(spark: SparkSession, path: str) -> DataFrame:
    """The stored payloads. Bytes that no longer give their digest fail the job."""
    payloads = spark.read.parquet(f"{path}/payloads")
    good = F.unhex(F.sha2("payload", 256)) == F.col("digest")
    checked = F.when(good, F.col("payload")).otherwise(F.raise_error(F.lit("a stored payload has changed")).cast("binary"))
    return payloads.select("digest", checked.alias("payload"))


def restore(spark: SparkSession, path: str) -> DataFrame:
    """Every original record: its bytes as one WARC record, and the full payload also for revisits."""
    block = F.when(F.col("record_type") == "revisit", F.lit(b"")).otherwise(F.col("payload"))
    joined = read_records(spark, path).join(read_payloads(spark, path), "digest")
    return joined.select(
        "page_id", "record_type", "refers_to", "url", "payload", F.concat("header", block, F.lit(b"\r\n\r\n")).alias("record")
    )


def describe(spark: SparkSession, path: str) -> DataFrame:
    """Per record what its header says and what the stored payload really is; the payload itself stays where it is."""
    facts = read_payloads(spark, path).select(
        "digest", F.length("payload").cast("long").alias("payload_bytes"), sha1_base32(F.col("payload")).alias("payload_digest")
    )
    rows = read_records(spark, path).join(facts, "digest")
    agreed = F.when(F.col("header_digest") == F.col("payload_digest"), F.col("payload_digest")).otherwise(
        F.raise_error(F.lit("header and payload disagree")).cast("string")
    )
    return rows.select("page_id", "payload_bytes", agreed.alias("payload_digest"), "record_type", "refers_to")


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{shared_dir(spark)}/warc-{uuid.uuid4().hex}"
    write_archive(table(spark, sf_dir, "pages"), path)
    return describe(spark, path)


SQL = f"""
WITH p AS (
    SELECT page_id, COALESCE(html, '') AS html, sha1(COALESCE(html, '')) AS h, MAX(page_id) OVER (PARTITION BY COALESCE(html, '')) AS r
    FROM pages
)
SELECT page_id, CAST(strlen(html) AS BIGINT) AS payload_bytes,
    array_to_string([
        substr('{BASE32}', CAST((CAST('0x' || substr(h, 1 + 10 * (i // 8), 10) AS BIGINT) >> (35 - 5 * (i % 8))) & 31 AS INTEGER) + 1, 1)
        FOR i IN range(0, 32)], '') AS payload_digest,
    CASE WHEN page_id = r THEN 'response' ELSE 'revisit' END AS record_type,
    CASE WHEN page_id = r THEN NULL ELSE r END AS refers_to
FROM p
"""
