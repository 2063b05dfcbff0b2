"""Content-addressed archive of WARC records.

Payload bytes are stored once per SHA-256; the exact header block of every
record is stored apart with that digest; records come back by joining the two.
Equal digests are verified to carry equal SHA-1 and length when payloads are
stored, and every stored payload is hashed again when it is read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from turnout.llm.common import table
from turnout.llm.registry import query
from turnout.session import scratch_path

REVISIT_BYTES = 1000
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"


@dataclass(frozen=True)
class Archive:
    """Two tables below one folder: ``headers`` (digest, header) and ``payloads`` (digest, payload)."""

    root: str

    def headers(self, spark: SparkSession) -> DataFrame:
        return spark.read.schema("digest string, header string").parquet(f"{self.root}/headers")

    def payloads(self, spark: SparkSession) -> DataFrame:
        return spark.read.schema("digest string, payload binary").parquet(f"{self.root}/payloads")


def _record_id(page: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), F.coalesce(page.cast("string"), F.lit("none")), F.lit(">"))


def _line(name: str, value: Column) -> Column:
    return F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))


def write_archive(pages: DataFrame, root: str, date: str = "1970-01-01T00:00:00Z",
                  min_revisit: int = REVISIT_BYTES) -> Archive:
    """One WARC record per row of ``pages`` (page_id, url, html; other columns are not read).

    A null html is an empty payload, a null url an empty target. Of records with
    equal payloads of at least ``min_revisit`` bytes, that with the largest
    page_id is the response and the others revisit it; rows repeating that
    page_id are responses too. Null ids come last; a group without any id is all
    responses. Line breaks in urls are percent-encoded. An empty table gives an
    empty archive. ``date`` stands in every record, as pages carry none.
    """
    spark = pages.sparkSession
    rows = pages.select(
        "page_id", "url", F.coalesce("html", F.lit("")).cast("binary").alias("payload"))
    keyed = rows.select(
        "page_id", "url", "payload", F.sha2("payload", 256).alias("digest"),
        F.sha1("payload").alias("sha1"), F.octet_length("payload").cast("long").alias("bytes"))
    kept = keyed.groupBy("digest").agg(
        F.first("payload").alias("payload"), F.max("page_id").alias("owner"),
        F.min("sha1").alias("sha1"), F.max("sha1").alias("other_sha1"),
        F.min("bytes").alias("bytes"), F.max("bytes").alias("other_bytes"))
    same = (F.col("sha1") == F.col("other_sha1")) & (F.col("bytes") == F.col("other_bytes"))
    kept.select(
        F.when(same, F.col("digest")).otherwise(F.raise_error(F.lit("digest collision"))).alias("digest"),
        "payload", "owner").write.option("compression", "zstd").parquet(f"{root}/payloads")

    owners = spark.read.schema("digest string, owner long").parquet(f"{root}/payloads")
    slim = keyed.select("page_id", "url", "digest", "sha1", "bytes").join(owners, "digest")
    revisit = ((F.col("bytes") >= min_revisit) & F.col("owner").isNotNull()
               & ~F.col("page_id").eqNullSafe(F.col("owner")))
    url = F.replace(F.replace(F.coalesce("url", F.lit("")), F.lit("\r"), F.lit("%0D")),
                    F.lit("\n"), F.lit("%0A"))
    length = F.when(revisit, F.lit(len(HTTP))).otherwise(F.lit(len(HTTP)) + F.col("bytes"))
    header = F.concat(
        F.lit("WARC/1.1\r\n"),
        _line("WARC-Type", F.when(revisit, F.lit("revisit")).otherwise(F.lit("response"))),
        _line("WARC-Record-ID", _record_id(F.col("page_id"))), _line("WARC-Date", F.lit(date)),
        _line("WARC-Target-URI", url), _line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), "sha1")),
        F.when(revisit, F.concat(_line("WARC-Refers-To", _record_id(F.col("owner"))),
                                 _line("WARC-Profile", F.lit(PROFILE)))).otherwise(F.lit("")),
        _line("Content-Type", F.lit("application/http; msgtype=response")),
        _line("Content-Length", length.cast("string")), F.lit("\r\n"), F.lit(HTTP))
    slim.select("digest", header.alias("header")).write.option("compression", "zstd").parquet(f"{root}/headers")
    return Archive(root)


def _field(name: str) -> Column:
    return F.regexp_extract("header", rf"\r\n{name}: ([^\r\n]*)\r\n", 1)


def _id(value: Column) -> Column:
    return F.regexp_extract(value, r"^<urn:page:(-?[0-9]+)>$", 1).try_cast("long")


def read_headers(archive: Archive, spark: SparkSession) -> DataFrame:
    """Parsed header blocks: digest, header, record_type, page_id, url, payload_sha1, refers_to."""
    return archive.headers(spark).select(
        "digest", "header", _field("WARC-Type").alias("record_type"),
        _id(_field("WARC-Record-ID")).alias("page_id"), _field("WARC-Target-URI").alias("url"),
        F.regexp_replace(_field("WARC-Payload-Digest"), "^sha1:", "").alias("payload_sha1"),
        _id(_field("WARC-Refers-To")).alias("refers_to"))


def verified_payloads(archive: Archive, spark: SparkSession) -> DataFrame:
    """Stored payloads with length and SHA-1, each hashed again; a damaged one is an error."""
    right = F.sha2("payload", 256) == F.col("digest")
    return archive.payloads(spark).select(
        F.when(right, F.col("digest")).otherwise(F.raise_error(F.lit("damaged payload"))).alias("digest"),
        "payload", F.octet_length("payload").cast("long").alias("payload_bytes"),
        F.sha1("payload").alias("payload_digest"))


def read_records(archive: Archive, spark: SparkSession) -> DataFrame:
    """Records as first written: parsed headers, payload, and the record's own bytes.

    A revisit's record holds its header block only; its payload still comes back.
    Every record is rebuilt and compared to its header: the length of its block to
    Content-Length, the SHA-1 of its payload to WARC-Payload-Digest. A difference
    is an error.
    """
    rows = read_headers(archive, spark).join(verified_payloads(archive, spark), "digest")
    body = F.when(F.col("record_type") == "response", F.col("payload")).otherwise(F.lit(b""))
    rows = rows.withColumn("record", F.concat(F.col("header").cast("binary"), body, F.lit(b"\r\n\r\n")))
    head = F.octet_length(F.substring_index("header", "\r\n\r\n", 1)) + 4
    whole = F.octet_length("record") - head - 4 == _field("Content-Length").try_cast("long")
    same = F.col("payload_digest") == F.col("payload_sha1")
    return rows.withColumn("payload", F.when(whole & same, F.col("payload")).otherwise(
        F.raise_error(F.concat(F.lit("damaged record of page "), F.coalesce(F.col("page_id").cast("string"), F.lit("none"))))))


def export_warc(archive: Archive, spark: SparkSession, path: str) -> None:
    """The records as gzipped WARC files, one per task."""
    # the writer puts the blank lines after each record
    text = F.expr("left(record_text, length(record_text) - 4)")
    read_records(archive, spark).select(F.col("record").cast("string").alias("record_text")).select(
        text.alias("value")).write.option("lineSep", "\r\n\r\n").option("compression", "gzip").text(path)


_SQL = """
WITH p AS (
  SELECT page_id, encode(coalesce(html, '')) AS b FROM pages),
d AS (
  SELECT page_id, octet_length(b) AS payload_bytes, sha1(b) AS payload_digest FROM p),
m AS (
  SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS owner FROM d)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 1000 AND page_id IS DISTINCT FROM owner THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 1000 AND page_id IS DISTINCT FROM owner THEN owner END AS refers_to
FROM m
"""


@query("op3_warc", _SQL)
def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages written as an archive; every record is rebuilt from its stored header and payload."""
    archive = write_archive(table(spark, sf_dir, "pages"), scratch_path(spark, "warc"))
    return read_records(archive, spark).select(
        "page_id", F.octet_length("payload").cast("long").alias("payload_bytes"),
        F.sha1("payload").alias("payload_digest"), "record_type", "refers_to")
