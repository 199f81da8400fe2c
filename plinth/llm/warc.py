"""Content-addressed WARC archive: headers and payloads stored apart, records rebuilt by joins.

A payload's bytes are stored once, under their SHA-256; the exact header block of each record is a
row of its own that names the payload. Reading checks every payload against its digest.

Defined cases: a null payload is empty; rows with equal ids are separate records; a null id is the
smallest. Control characters and spaces cannot stand in a header: such an address is written with
them percent-encoded, and whole, as form encoding, in a field of its own, from which it is read. A
null address has no field. Other columns of the input are not read, so their names cannot clash.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plinth.llm.skew import text_dealt_anew
from plinth.session import new_dir

#: Payloads shorter than this are never replaced by a revisit record.
REVISIT_FROM = 1000

CRLF = "\r\n"
NO_ID = "none"
EXACT_ADDRESS = "X-Exact-Address"


@dataclass(frozen=True)
class Archive:
    """``headers``: header, payload_key. ``payloads``: payload_key (SHA-256), payload."""

    headers: str
    payloads: str


def records(pages: DataFrame, page_id: str = "page_id", url: str = "url", body: str = "html") -> DataFrame:
    """Rows page_id, header, payload_key, payload: what :func:`write` stores.

    Of records with equal payloads of at least ``REVISIT_FROM`` bytes, the one with the largest
    id is the response and the others revisit it.
    """
    payload = F.coalesce(F.col(body), F.lit("")).cast("binary")
    rows = pages.select(
        F.col(page_id).alias("page_id"), F.col(url).alias("url"), payload.alias("payload")
    ).withColumn("payload_key", F.sha2("payload", 256))
    large = F.octet_length("payload") >= REVISIT_FROM
    # one row per digest and task leaves the scan, so a payload that everybody has is no hot group
    newest = (
        rows.where(large).groupBy("payload_key")
        .agg(F.max("page_id").alias("newest"), F.count(F.lit(1)).alias("copies"))
        .where("copies > 1").select(text_dealt_anew("payload_key").alias("key"), "newest")
    )
    facts = rows.select(
        "page_id", "url", "payload_key", F.octet_length("payload").alias("n"),
        F.sha1("payload").alias("sha1"),
    )
    joined = facts.join(newest, F.col("payload_key") == F.col("key"), "left")
    revisit = F.col("key").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("newest"))
    return joined.select(header(revisit).alias("header"), "payload_key")


def _id(column: str) -> Column:
    return F.concat(F.lit("<urn:page:"), F.coalesce(F.col(column).cast("string"), F.lit(NO_ID)), F.lit(">"))


def header(revisit: Column) -> Column:
    """The header block of a record, with the empty line that ends it."""
    lines = F.concat(
        F.lit(f"WARC/1.1{CRLF}WARC-Type: "), F.when(revisit, "revisit").otherwise("response"),
        F.lit(f"{CRLF}WARC-Record-ID: "), _id("page_id"),
        F.when(revisit, F.concat(F.lit(f"{CRLF}WARC-Refers-To: "), _id("newest"))).otherwise(""),
        F.when(F.col("url").isNull(), "").otherwise(_address("url")),
        F.lit(f"{CRLF}WARC-Payload-Digest: sha1:"), F.col("sha1"),
        F.lit(f"{CRLF}Content-Type: text/html{CRLF}Content-Length: "),
        F.when(revisit, F.lit(0)).otherwise(F.col("n")).cast("string"),
    )
    return F.concat(lines, F.lit(CRLF + CRLF))


def _address(url: str) -> Column:
    """The field with an address, and a second one if the first does not hold it as it is."""
    unsafe = [chr(c) for c in (*range(33), 127)]
    safe = reduce(lambda text, c: F.replace(text, F.lit(c), F.lit(f"%{ord(c):02X}")), unsafe, F.col(url))
    plain = F.concat(F.lit(f"{CRLF}WARC-Target-URI: "), F.col(url))
    both = F.concat(F.lit(f"{CRLF}WARC-Target-URI: "), safe, F.lit(f"{CRLF}{EXACT_ADDRESS}: "), F.url_encode(url))
    return F.when(F.col(url).rlike(r"[\x00-\x20\x7F]"), both).otherwise(plain)


def address() -> Column:
    """The address of a record, as it was, from the column ``header``; null if it had none."""
    exact = field(EXACT_ADDRESS)
    named = F.col("header").contains(f"{CRLF}WARC-Target-URI: ")
    return F.when(exact != "", F.url_decode(exact)).when(named, field("WARC-Target-URI"))


def write(pages: DataFrame, archive: Archive, **columns: str) -> Archive:
    """Write headers and payloads as two Parquet tables."""
    body = columns.get("body", "html")
    payload = F.coalesce(F.col(body), F.lit("")).cast("binary")
    once = pages.select(F.sha2(payload, 256).alias("payload_key"), payload.alias("payload")).dropDuplicates(["payload_key"])
    once.write.option("compression", "zstd").parquet(archive.payloads)
    records(pages, **columns).write.option("compression", "zstd").parquet(archive.headers)
    return archive


def read(spark: SparkSession, archive: Archive) -> DataFrame:
    """Rows header, payload, record, url: ``record`` is the record as a WARC file would hold it.

    Fails if a payload does not have the digest it is stored under, or if a header names a
    payload that is not there.
    """
    stored = spark.read.schema("payload_key string, payload binary").parquet(archive.payloads)
    intact = F.sha2("payload", 256) == F.col("payload_key")
    verified = stored.select(
        F.col("payload_key").alias("key"),
        F.when(intact, F.col("payload")).otherwise(F.raise_error(F.lit("payload does not match its digest")).cast("binary"))
        .alias("payload"),
    )
    headers = spark.read.schema("header string, payload_key string").parquet(archive.headers)
    rows = headers.join(verified, F.col("payload_key") == F.col("key"), "left")
    found = F.coalesce("payload", F.raise_error(F.lit("a payload is missing")).cast("binary"))
    own = F.when(field("WARC-Type") == "revisit", F.lit(b"")).otherwise(found)
    end = F.lit((CRLF + CRLF).encode())
    return rows.select(
        "header", found.alias("payload"), F.concat(F.col("header").cast("binary"), own, end).alias("record"), address().alias("url")
    )


def field(name: str) -> Column:
    """A field of the column ``header``; empty text if it has none."""
    return F.regexp_extract("header", rf"\r\n{name}: ([^\r]*)\r\n", 1)


def _number(name: str) -> Column:
    text = F.regexp_extract(field(name), r"^<urn:page:(-?\d+)>$", 1)
    return F.when(text != "", text.cast("bigint"))


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Archive all pages, read the archive back, and report each record as it was rebuilt."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    place = new_dir(spark, "warc")
    rebuilt = read(spark, write(pages, Archive(f"{place}/headers", f"{place}/payloads")))
    body = F.octet_length("record") - F.octet_length("header") - 4
    whole = F.col("record").isNotNull() & (body == field("Content-Length").cast("int"))
    digest = F.sha1("payload")
    same = whole & (F.concat(F.lit("sha1:"), digest) == field("WARC-Payload-Digest"))
    return rebuilt.select(
        _number("WARC-Record-ID").alias("page_id"),
        F.octet_length("payload").cast("bigint").alias("payload_bytes"),
        F.when(same, digest).otherwise(F.raise_error(F.lit("a record was not rebuilt as it was")).cast("string"))
        .alias("payload_digest"),
        field("WARC-Type").alias("record_type"),
        _number("WARC-Refers-To").alias("refers_to"),
    )


OP9_SQL = f"""
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages),
d AS (SELECT page_id, octet_length(payload) AS n, sha1(payload) AS digest FROM p),
k AS (SELECT digest, max(page_id) AS newest FROM d WHERE n >= {REVISIT_FROM} GROUP BY digest)
SELECT d.page_id, CAST(d.n AS BIGINT) AS payload_bytes, d.digest AS payload_digest,
       CASE WHEN d.n < {REVISIT_FROM} OR d.page_id IS NOT DISTINCT FROM k.newest THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN d.n >= {REVISIT_FROM} AND d.page_id IS DISTINCT FROM k.newest THEN k.newest END AS refers_to
FROM d LEFT JOIN k ON d.digest = k.digest
"""
