"""A content-addressed WARC archive.

Two tables make up an archive: ``records`` has the exact header block of every record, ``payloads`` has the
bytes of every distinct payload once, under their SHA-256. Reading takes the digest of the stored
bytes again, stops if it differs, and joins headers and payloads to the original records.

Of records with equal payloads of at least ``least`` bytes, the one with the smallest id is a response and the
others are revisits that refer to it; smaller payloads are always responses.

Defined cases: null html is the empty payload; a null url gives no target line; a null id is last in the order, its record
has no id number, and several null ids share the response; rows that repeat an id and its payload are the same record written again and share its type; an empty table makes an
empty archive. Other columns are left out.
"""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tollgate.sources.shared import shared_folder

LEAST = 100
#: Pages carry no time of capture; the format wants one.
DATE = "1970-01-01T00:00:00Z"
VERSION = "WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
END = "\r\n"


def new_archive(df: DataFrame) -> str:
    return f"{shared_folder(df.sparkSession)}/llm/archive-{uuid4().hex}"


def _line(name: str, value: Column) -> Column:
    """A header line, empty for a null value; line ends inside a value are percent-encoded."""
    safe = F.replace(F.replace(value, F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    return F.coalesce(F.concat(F.lit(f"{name}: "), safe, F.lit(END)), F.lit(""))


def _name(page_id: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), F.coalesce(page_id.cast("string"), F.lit("")), F.lit(">"))


def write_archive(pages: DataFrame, path: str, least: int = LEAST) -> None:
    """Write headers and payloads of ``pages`` (page_id, url, html)."""
    payload = F.coalesce("html", F.lit(""))
    addressed = pages.select(
        "page_id", "url", payload.alias("payload"), F.sha2(payload, 256).alias("digest"),
        F.octet_length(payload).cast("bigint").alias("length"))
    first = addressed.groupBy("digest").agg(F.min("page_id").alias("_first"))
    # The bytes of a digest come from its first page; the page is part of the key, so copies spread over the
    # tasks, and a repeated first page is dropped where the join has put it.
    place = F.coalesce(F.col("page_id").cast("string"), F.lit("-"))
    source = addressed.select("digest", place.alias("place"), "payload")
    holder = first.select("digest", F.coalesce(F.col("_first").cast("string"), F.lit("-")).alias("place"))
    bytes_once = source.join(holder, ["digest", "place"]).dropDuplicates(["digest", "place"])
    bytes_once.select("digest", F.encode("payload", "UTF-8").alias("payload")).write.parquet(f"{path}/payloads")

    narrow = addressed.select("page_id", "url", "digest", "length").join(first.select("digest", "_first"), "digest")
    revisit = (F.col("length") >= least) & ~F.col("page_id").eqNullSafe(F.col("_first"))
    kind = F.when(revisit, "revisit").otherwise("response")
    header = F.concat(
        F.lit(VERSION + END), _line("WARC-Type", kind), _line("WARC-Record-ID", _name(F.col("page_id"))),
        _line("WARC-Date", F.lit(DATE)), _line("WARC-Target-URI", F.col("url")),
        _line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("digest"))),
        _line("WARC-Refers-To", F.when(revisit, _name(F.col("_first")))), _line("WARC-Profile", F.when(revisit, F.lit(PROFILE))),
        _line("Content-Type", F.lit("text/html; charset=utf-8")),
        _line("Content-Length", F.when(revisit, F.lit("0")).otherwise(F.col("length").cast("string"))), F.lit(END))
    narrow.select("digest", F.encode(header, "UTF-8").alias("header")).write.parquet(f"{path}/records")


def _value(header: Column, name: str) -> Column:
    found = F.regexp_extract(header, rf"(?:\r\n){name}: ([^\r\n]*)\r\n", 1)
    return F.when(found != "", found)


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """Every record: page_id, url, record_type, refers_to, payload_digest, payload_bytes, header, payload.

    A payload whose digest does not match stops the read. ``payload`` is the full payload, also for revisits.
    """
    records = spark.read.parquet(f"{path}/records")
    stored = spark.read.parquet(f"{path}/payloads")
    actual = F.sha2("payload", 256)
    verified = F.when(actual == F.col("digest"), actual).otherwise(F.raise_error(F.concat(F.lit("payload differs from its digest "), F.col("digest"))))
    payloads = stored.select("digest", "payload", verified.alias("verified"), F.octet_length("payload").cast("bigint").alias("payload_bytes"))
    text = F.decode("header", "UTF-8")
    parsed = records.select(
        "digest", "header", _value(text, "WARC-Type").alias("record_type"), _value(text, "WARC-Target-URI").alias("url"),
        F.regexp_extract(text, r"WARC-Record-ID: <urn:page:(-?\d*)>", 1).try_cast("bigint").alias("page_id"),
        F.regexp_extract(text, r"WARC-Refers-To: <urn:page:(-?\d*)>", 1).try_cast("bigint").alias("refers_to"),
        F.regexp_extract(text, r"WARC-Payload-Digest: sha256:([0-9a-f]{64})\r", 1).alias("stated"))
    joined = parsed.join(payloads, "digest", "left")
    digest = F.when(F.col("stated") == F.col("verified"), F.col("verified")).otherwise(
        F.raise_error(F.concat(F.lit("no payload for "), F.col("stated"))))
    return joined.select(
        "page_id", "url", "record_type", "refers_to", digest.alias("payload_digest"), "payload_bytes", "header", "payload")


def records(archive: DataFrame) -> DataFrame:
    """page_id and the complete WARC record: header block, block (none for a revisit), and the closing line ends."""
    block = F.when(F.col("record_type") == "response", F.col("payload")).otherwise(F.lit(b""))
    return archive.select("page_id", F.concat("header", block, F.lit((END + END).encode())).alias("record"))
