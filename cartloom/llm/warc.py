"""Content-addressed WARC archive.

An archive is a folder of two Parquet tables. ``payloads`` stores the bytes of every
distinct payload once under its SHA-256 (the content key); ``headers`` keeps the exact
header block of every record with the content key of its payload. The original records
are rebuilt by joining the two on the content key. Payload bytes are hashed again when
they are read, so a stored payload that does not fit its key fails the read.

Record rules: of records with equal payloads of at least ``min_revisit`` bytes the one
with the largest id is the ``response`` and the others are ``revisit`` records that refer
to it; smaller payloads always give ``response`` records.

Edge cases: a null body is the empty payload; a null or line-breaking URI is written with
its control characters percent-encoded (null: no target line); rows that repeat an id with
an equal payload are all responses when they hold the largest id; a null id never is the
largest unless all ids of the payload are null, and refers to nothing then; an empty table
gives an empty archive. Other columns of the input are ignored.

Scale: payload bytes cross the network once, keyed by (id, content key), so a payload that
a third of all records share does not meet in one task; the owners of repeated payloads are
landed, which lets Spark split the joins on a hot content key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cartloom.llm.common import landed, table
from cartloom.session import scratch_path

PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
CRLF = "\r\n"


def _facts(pages: DataFrame, id_col: str, uri_col: str, body_col: str) -> DataFrame:
    payload = F.encode(F.coalesce(F.col(body_col).cast("string"), F.lit("")), "UTF-8")
    return (pages.select(F.col(id_col).cast("long").alias("record"), F.col(uri_col).alias("uri"),
                         payload.alias("payload"))
            .withColumn("n", F.octet_length("payload").cast("long"))
            .withColumn("content", F.sha2("payload", 256)))


def _header(date: str) -> Column:
    """The header block of a record, up to and with its empty line."""
    line = lambda name, value: F.concat(F.lit(name + ": "), value, F.lit(CRLF))
    uri = F.regexp_replace(F.regexp_replace(F.regexp_replace("uri", "%", "%25"), "\r", "%0D"),
                           "\n", "%0A")
    urn = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(c.cast("string"), F.lit("")), F.lit(">"))
    revisit = F.col("owner").isNotNull() & ~F.col("owner").eqNullSafe(F.col("record"))
    none = F.lit("")
    return F.concat(
        F.lit("WARC/1.1" + CRLF),
        line("WARC-Type", F.when(revisit, F.lit("revisit")).otherwise(F.lit("response"))),
        line("WARC-Record-ID", urn(F.col("record"))),
        F.when(F.col("uri").isNotNull(), line("WARC-Target-URI", uri)).otherwise(none),
        line("WARC-Date", F.lit(date)),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("sha1"))),
        F.when(revisit, F.concat(line("WARC-Refers-To", urn(F.col("owner"))),
                                 line("WARC-Profile", F.lit(PROFILE)))).otherwise(none),
        line("Content-Type", F.lit("text/html; charset=utf-8")),
        line("Content-Length", F.when(revisit, F.lit("0")).otherwise(F.col("n").cast("string"))),
        F.lit(CRLF))


def write_archive(pages: DataFrame, path: str, id_col: str = "page_id", uri_col: str = "url",
                  body_col: str = "html", min_revisit: int = 1000,
                  date: str = "2024-01-01T00:00:00Z") -> str:
    """Write one record per row of ``pages`` to the archive folder ``path``; returns ``path``."""
    facts = _facts(pages, id_col, uri_col, body_col)
    # Payloads of several records: their owner is the record with the largest id.
    repeated = landed(facts.groupBy("content").agg(F.max("record").alias("owner"),
                                                   F.count(F.lit(1)).alias("copies"))
                      .where("copies > 1").drop("copies"), "warc-owners")
    refers = F.when(F.col("n") >= min_revisit, F.col("holder")).alias("owner")
    holders = repeated.withColumnRenamed("owner", "holder")
    head = facts.withColumn("sha1", F.sha1("payload")).drop("payload").join(holders, "content", "left")
    (head.select("record", "content", "uri", "n", "sha1", refers)
         .select("record", "content", _header(date).alias("header"))
         .write.mode("overwrite").option("compression", "zstd").parquet(f"{path}/headers"))
    # A payload is kept by its owner's row; bytes move once, keyed by (id, content), and rows
    # that repeat the owner's id, which hold the same bytes, fold into one.
    # The id takes part as text, null as none, so that the join and the folding share their keys
    # and one exchange serves both.
    key = F.coalesce(F.col("record").cast("string"), F.lit(""))
    owners = (facts.groupBy("content").agg(F.max("record").alias("record"))
              .select("content", key.alias("key")))
    kept = facts.select("content", key.alias("key"), "payload").join(owners, ["content", "key"])
    (kept.dropDuplicates(["content", "key"]).select("content", "payload")
         .write.mode("overwrite").option("compression", "zstd").parquet(f"{path}/payloads"))
    return path


def _verified(spark: SparkSession, path: str) -> DataFrame:
    """Stored payloads with their length and SHA-1; fails on bytes that do not fit their key."""
    stored = spark.read.schema("content string, payload binary").parquet(f"{path}/payloads")
    return stored.withColumn("content", F.when(
        F.sha2("payload", 256) == F.col("content"), F.col("content")).otherwise(
            F.raise_error(F.concat(F.lit("payload does not fit its key "), F.col("content")))))


def _headers(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("record long, content string, header string").parquet(f"{path}/headers")


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """One row per archived record, from its parsed header and its verified payload:
    ``page_id, payload_bytes, payload_digest, record_type, refers_to, uri``."""
    field = lambda name: F.regexp_extract("header", rf"\r\n{name}: ([^\r]*)\r\n", 1)
    number = lambda name: F.regexp_extract(
        "header", rf"\r\n{name}: <urn:page:(-?\d+)>\r\n", 1)
    plain = lambda c: F.regexp_replace(F.regexp_replace(F.regexp_replace(
        c, "%0A", "\n"), "%0D", "\r"), "%25", "%")
    facts = _verified(spark, path).select(
        "content", F.octet_length("payload").cast("long").alias("payload_bytes"),
        F.sha1("payload").alias("stored_sha1"))
    parsed = _headers(spark, path).select(
        "content",
        F.nullif(number("WARC-Record-ID"), F.lit("")).cast("long").alias("page_id"),
        F.regexp_replace(field("WARC-Payload-Digest"), "^sha1:", "").alias("digest"),
        field("WARC-Type").alias("record_type"),
        F.nullif(number("WARC-Refers-To"), F.lit("")).cast("long").alias("refers_to"),
        F.when(F.col("header").contains("\r\nWARC-Target-URI: "),
               plain(field("WARC-Target-URI"))).alias("uri"))
    same = F.col("digest").eqNullSafe(F.col("stored_sha1"))
    return parsed.join(facts, "content", "left").select(
        "page_id", "payload_bytes",
        F.when(same, F.col("digest")).otherwise(F.raise_error(F.concat(
            F.lit("record without its payload: "), F.col("content")))).alias("payload_digest"),
        "record_type", "refers_to", "uri")


def reconstruct(spark: SparkSession, path: str) -> DataFrame:
    """``record`` id, the exact WARC record ``bytes`` and the full ``payload`` (also of
    revisits, whose own block is empty), rebuilt by the join on the content key."""
    joined = _headers(spark, path).join(_verified(spark, path), "content")
    block = F.when(F.col("header").contains("\r\nWARC-Type: revisit\r\n"),
                   F.lit("").cast("binary")).otherwise(F.col("payload"))
    end = F.lit(CRLF + CRLF).cast("binary")
    return joined.select("record", F.concat(F.encode("header", "UTF-8"), block, end).alias("bytes"),
                         "payload")


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Archive every page and read the archive back."""
    path = write_archive(table(spark, sf_dir, "pages"), scratch_path(spark, "warc"))
    return read_archive(spark, path)


OP3_SQL = r"""
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS body FROM pages),
f AS (SELECT page_id, octet_length(body)::BIGINT AS payload_bytes, sha1(body) AS payload_digest,
             sha256(body) AS k FROM p),
o AS (SELECT k, max(page_id) AS owner FROM f GROUP BY k)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 1000 AND page_id <> owner THEN 'revisit' ELSE 'response' END
         AS record_type,
       CASE WHEN payload_bytes >= 1000 AND page_id <> owner THEN owner END AS refers_to,
       url AS uri
FROM f JOIN o USING (k) JOIN pages USING (page_id)
"""
