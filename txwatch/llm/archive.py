"""Content-addressed WARC archive.

Payload bytes are stored once under their SHA-256; the exact header block of every record is kept apart and
names the payload's digest. A record is its header block, the payload that the join brings back, and the
closing line breaks. Reading verifies length and digests and fails on a mismatch.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

EOL = "\r\n"
DATE = "2024-01-01T00:00:00Z"
#: Fixed value: the profile that WARC 1.1 asks of a revisit with an equal payload.
SAME_PAYLOAD = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: The record id of a null page_id, which no page's id can equal.
NO_PAGE = "<urn:no-page>"


def base32_sha1(payload: Column) -> Column:
    """The SHA-1 of some bytes in base 32: five hex digits (20 bits) become four characters."""
    digest = F.sha1(payload)
    groups = [F.lpad(F.conv(F.substring(digest, 1 + 5 * k, 5), 16, 32), 4, "0") for k in range(8)]
    return F.translate(F.concat(*groups), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def _header(url: Column, fields: list[tuple[str, Column]]) -> Column:
    """A header block; fields whose value is null are left out."""
    lines = [F.lit("WARC/1.1" + EOL)]
    for name, value in [("WARC-Target-URI", url), *fields]:
        lines.append(F.coalesce(F.concat(F.lit(f"{name}: "), value.cast("string"), F.lit(EOL)), F.lit("")))
    return F.concat(*lines, F.lit(EOL)).cast("binary")


def write_archive(pages: DataFrame, path: str, min_bytes: int = 0) -> None:
    """Write one record per row of `pages` (page_id, url, html): `path`/payloads and `path`/headers.

    Of the records with equal payloads of at least `min_bytes` bytes, the one with the smallest page_id is a
    response and the others revisit it; smaller payloads are responses throughout. A null html is an empty
    payload. Rows that repeat a response's page_id and payload are responses too. A null page_id is a response
    only where its payload has no other, and its record's own id is NO_PAGE.
    """
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    records = pages.select(
        "page_id", F.regexp_replace("url", r"[\r\n]", "").alias("url"), payload.alias("payload"),
        F.sha2(payload, 256).alias("digest"), base32_sha1(payload).alias("sha1"),
        F.octet_length(payload).cast("long").alias("n_bytes"),
    )
    # Equal digests are equal payloads, so any one serves; copies are dropped before and after the one exchange of bytes.
    records.select("digest", "payload").dropDuplicates(["digest"]).withColumn(
        "n_bytes", F.octet_length("payload").cast("long")
    ).write.parquet(f"{path}/payloads")
    narrow = records.drop("payload")
    first = narrow.groupBy("digest").agg(F.min("page_id").alias("page_id"))
    joined = narrow.join(first.withColumnRenamed("page_id", "first_id"), "digest")
    revisit = (F.col("n_bytes") >= min_bytes) & ~F.col("page_id").eqNullSafe(F.col("first_id"))
    urn = lambda c: F.coalesce(F.concat(F.lit("<urn:page:"), c.cast("string"), F.lit(">")), F.lit(NO_PAGE))
    header = _header(
        F.col("url"),
        [
            ("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
            ("WARC-Record-ID", urn(F.col("page_id"))),
            ("WARC-Date", F.lit(DATE)),
            ("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("sha1"))),
            ("WARC-Refers-To", F.when(revisit, urn(F.col("first_id")))),
            ("WARC-Profile", F.when(revisit, F.lit(SAME_PAYLOAD))),
            ("Content-Type", F.lit("text/html; charset=utf-8")),
            ("Content-Length", F.when(revisit, F.lit(0)).otherwise(F.col("n_bytes"))),
        ],
    )
    joined.select("page_id", F.col("digest").alias("payload_key"), header.alias("header")).write.parquet(f"{path}/headers")


def read_archive(spark: SparkSession, path: str, page_id_type: str = "bigint") -> DataFrame:
    """Reconstruct every record: page_id, header, payload (the full one, for revisits too) and record bytes.

    `refers_to` is null where the header refers to no page.

    A payload whose SHA-256, SHA-1 or length disagrees with its key or header stops the query, and so does a
    rebuilt record that does not hold its header, its payload and the closing line breaks at their places.
    `payload_digest` is given only after that, so whoever reads it has had the records rebuilt.
    """
    headers = spark.read.schema(f"page_id {page_id_type}, payload_key string, header binary").parquet(f"{path}/headers")
    payloads = spark.read.schema("digest string, n_bytes bigint, payload binary").parquet(f"{path}/payloads")
    # Digests and lengths are verified once per stored payload, before copies fan out.
    sound = (F.sha2("payload", 256) == F.col("digest")) & (F.octet_length("payload") == F.col("n_bytes"))
    verified = payloads.select(
        "digest", "n_bytes", base32_sha1(F.col("payload")).alias("sha1"), F.sha1("payload").alias("sha1_hex"),
        F.when(sound, F.col("payload")).otherwise(F.raise_error(F.lit("payload does not match its digest")).cast("binary")).alias("payload"),
    )
    text = F.col("header").cast("string")
    field = lambda name: F.regexp_extract(text, rf"\r\n{name}: ([^\r\n]*)", 1)
    referred, page = field("WARC-Refers-To"), "^<urn:page:(.*)>$"
    records = headers.join(verified, headers["payload_key"] == verified["digest"], "left").select(
        "page_id", "header", "payload", "n_bytes", "sha1", "sha1_hex",
        field("WARC-Type").alias("record_type"),
        F.regexp_replace(field("WARC-Payload-Digest"), "^sha1:", "").alias("payload_digest"),
        F.when(referred.rlike(page), F.regexp_extract(referred, page, 1)).alias("refers_to"),
        field("Content-Length").cast("long").alias("content_length"),
    )
    body = F.when(F.col("record_type") == "response", F.col("payload")).otherwise(F.lit(b""))
    agrees = (F.col("sha1") == F.col("payload_digest")) & (F.octet_length(body) == F.col("content_length"))
    closing = F.lit((EOL * 2).encode())
    record = F.concat(F.col("header"), body, closing)
    at, size = F.octet_length("header"), F.col("content_length").cast("int")
    whole = (
        (F.octet_length(record) == at + size + len(EOL * 2))
        & (F.substring(record, F.lit(1), at) == F.col("header"))
        & ((F.col("record_type") != "response") | (F.sha1(F.substring(record, at + 1, size)) == F.col("sha1_hex")))
        & (F.substring(record, at + size + 1, F.lit(len(EOL * 2))) == closing)
    )
    return records.select(
        "page_id", "header", "payload", "n_bytes", "record_type", "refers_to",
        F.when(agrees & whole, F.col("payload_digest"))
        .otherwise(F.raise_error(F.lit("record header does not match its payload")).cast("string"))
        .alias("payload_digest"),
        record.alias("record"),
    )


def export_warc(records: DataFrame, path: str, records_per_file: int = 50_000) -> None:
    """Write reconstructed records as gzipped WARC files through Spark's text sink.

    Every record ends in two line breaks, so those serve as the sink's line separator.
    """
    text = F.col("record").cast("string")
    lines = records.select(F.substring(text, F.lit(1), F.length(text) - 4).alias("value"))
    sink = lines.write.option("lineSep", EOL * 2).option("compression", "gzip")
    sink.option("maxRecordsPerFile", records_per_file).text(path)
