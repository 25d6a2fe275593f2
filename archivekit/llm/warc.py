"""A content-addressed WARC archive.

Two tables in one folder: `payloads` holds the bytes of each distinct payload once,
under their SHA-256; `headers` holds the exact header bytes of every record. Records
are put together again by a join on the digest. Of records with equal payloads of at
least `least_bytes`, the one with the smallest id is a `response` that carries them and
the others `revisit` it; smaller payloads are `response` records throughout, yet stored
once as well. Payloads move once, to the record that stores them; everything else is
decided on ids and digests, so a digest that a third of all pages share is a narrow
hot key, which merges before the shuffle and whose join can be split.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from archivekit.operators.workspace import new_folder, stage

CRLF = "\r\n"
HTTP_HEAD = f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: %d{CRLF}{CRLF}"


def _hex(digest: Column) -> Column:
    return F.lower(F.hex(digest))


def _record_id(record: Column) -> Column:
    """A name-based URN: equal for equal ids, so revisits can refer to it."""
    h = F.md5(F.concat(F.lit("record:"), F.coalesce(record.cast("string"), F.lit("none"))))
    parts = [F.substring(h, i, n) for i, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *parts), F.lit(">"))


def _line(name: str, value: Column) -> Column:
    """One header line, none for null; line ends inside a value become blanks."""
    line = F.concat(F.lit(f"{name}: "), F.regexp_replace(value.cast("string"), "[\r\n]+", " "), F.lit(CRLF))
    return F.coalesce(line, F.lit(""))


def _headers(date: str) -> Column:
    """The record's exact header, up to and with the empty line; the HTTP head belongs to it."""
    http = F.when(F.col("refers_to").isNull(), F.format_string(HTTP_HEAD, F.col("payload_bytes"))).otherwise("")
    length = F.octet_length(http) + F.when(F.col("refers_to").isNull(), F.col("payload_bytes")).otherwise(0)
    none = F.lit("")
    digest = F.concat(F.lit("sha256:"), _hex(F.col("digest")))
    return F.encode(F.concat(
        F.lit(f"WARC/1.1{CRLF}"),
        _line("WARC-Type", F.when(F.col("refers_to").isNull(), "response").otherwise("revisit")),
        F.concat(F.lit("WARC-Record-ID: "), _record_id(F.col("record")), F.lit(CRLF)),
        _line("WARC-Date", F.lit(date)),
        _line("WARC-Target-URI", F.col("url")),
        _line("WARC-Payload-Digest", digest),
        F.when(F.col("refers_to").isNotNull(), F.concat(
            F.lit("WARC-Refers-To: "), _record_id(F.col("refers_to")), F.lit(CRLF),
            F.lit(f"WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest{CRLF}"),
        )).otherwise(none),
        _line("X-Record-Key", F.col("record")),
        _line("X-Refers-To-Key", F.col("refers_to")),
        F.lit(f"Content-Type: application/http; msgtype=response{CRLF}"),
        _line("Content-Length", length),
        F.lit(CRLF), http,
    ), "utf-8")


def write_archive(pages: DataFrame, folder: str, least_bytes: int = 100, date: str = "2025-01-01T00:00:00Z") -> None:
    """Archive `pages` (page_id, url, html) as the tables `headers` and `payloads`.

    A null html is an empty payload, a null url leaves its header out. Rows without
    page_id, or repeated under one, are records of their own; which of several equal
    rows with one id responds does not show in the ids. Without rows, both tables are
    written empty.
    """
    pages = pages.select(
        F.col("page_id").cast("long").alias("record"), F.col("url").cast("string").alias("url"),
        F.coalesce(F.encode(F.col("html").cast("string"), "utf-8"), F.lit(b"")).alias("payload"))
    digest = F.unhex(F.sha2("payload", 256)).alias("digest")
    size = F.octet_length("payload").cast("long").alias("payload_bytes")
    narrow = stage(pages.select("record", "url", digest, size), "records")
    named = F.min("record").alias("first"), F.max("payload_bytes").alias("most"), F.min("payload_bytes").alias("fewest")
    owners = narrow.groupBy("digest").agg(*named)
    owners = stage(owners.withColumn("refers", (F.col("fewest") >= least_bytes) & (F.col("first").isNotNull())), "owners")
    if owners.filter("most != fewest").count():
        raise ValueError("one digest stands for payloads of several lengths")

    known = narrow.join(owners.select("digest", "first", "refers"), "digest")
    other = F.col("refers") & (F.coalesce(F.col("record") != F.col("first"), F.lit(True)))
    known = known.withColumn("refers_to", F.when(other, F.col("first")))
    known.select("record", "digest", "payload_bytes", _headers(date).alias("header")).write.mode("overwrite").parquet(
        f"{folder}/headers")

    # Payloads move once, by record and digest: an even key, however many share a digest.
    keep = owners.select("digest", "first")
    both = pages.select("record", "payload", digest).join(
        keep.withColumnRenamed("first", "record"), ["record", "digest"], "left_semi")
    nameless = pages.filter("record IS NULL").select("payload", digest).join(
        keep.filter("first IS NULL").select("digest"), "digest", "left_semi")
    both = both.select("digest", "payload").unionByName(nameless.select("digest", "payload"))
    # A repeated owner row would store its bytes twice.
    repeated = narrow.join(owners, (narrow["digest"] == owners["digest"]) & narrow["record"].eqNullSafe(owners["first"]), "left_semi")
    if repeated.groupBy("digest").count().filter("count > 1").isEmpty():
        both.write.mode("overwrite").parquet(f"{folder}/payloads")
    else:
        both.dropDuplicates(["digest"]).write.mode("overwrite").parquet(f"{folder}/payloads")


def read_payloads(spark: SparkSession, folder: str) -> DataFrame:
    """The stored bytes, each checked against its digest; a damaged one ends the read."""
    found = spark.read.parquet(f"{folder}/payloads")
    right = F.unhex(F.sha2("payload", 256)) == F.col("digest")
    checked = F.when(right, F.col("payload")).otherwise(
        F.raise_error(F.concat(F.lit("damaged payload "), _hex(F.col("digest")))).cast("binary"))
    return found.select("digest", checked.alias("payload"))


def read_records(spark: SparkSession, folder: str) -> DataFrame:
    """One row per record: its header's fields, the header bytes and the payload.

    The payload of a revisit is that of its response, found by the digest.
    """
    headers = spark.read.parquet(f"{folder}/headers")
    text = F.decode("header", "utf-8")

    def field(name: str) -> Column:
        # Lines end with a line feed only: other separators may stand inside a value.
        found = F.regexp_extract(text, f"(?md)^{name}: ([^\r\n]*)\r?$", 1)
        return F.when(found != "", found)

    fields = headers.select(
        field("X-Record-Key").cast("long").alias("record"), field("WARC-Type").alias("record_type"),
        F.unhex(F.substring(field("WARC-Payload-Digest"), 8, 64)).alias("digest"),
        field("X-Refers-To-Key").cast("long").alias("refers_to"), "header")
    return fields.join(read_payloads(spark, folder), "digest")


def record_bytes() -> Column:
    """The whole WARC record: header, the payload if it carries one, and the closing lines."""
    body = F.when(F.col("record_type") == "response", F.col("payload")).otherwise(F.lit(b""))
    return F.concat(F.col("header"), body, F.lit(b"\r\n\r\n"))


def archived(pages: DataFrame, least_bytes: int = 100) -> DataFrame:
    """Write the pages to a new archive in the shared folder and read its records back.

    Gives page_id, payload_bytes, payload_digest, record_type, refers_to and
    record_length, the bytes of the whole record.
    """
    spark = pages.sparkSession
    folder = new_folder(spark, "warc")
    write_archive(pages, folder, least_bytes)
    return read_records(spark, folder).select(
        F.col("record").alias("page_id"), F.octet_length("payload").cast("long").alias("payload_bytes"),
        F.sha2("payload", 256).alias("payload_digest"), "record_type", "refers_to",
        F.octet_length(record_bytes()).cast("long").alias("record_length"))
