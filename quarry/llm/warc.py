"""Content-addressed WARC archive: payloads once by SHA-256, exact record headers apart, records by joins.

An archive is two Parquet tables below one path:

* ``payloads(digest binary, payload binary, first_id long)`` - each distinct payload once;
* ``headers(page_id long, digest binary, header string)`` - the exact WARC/1.1 header of each record.

Defined results for odd input: null html is an empty payload; a null url leaves WARC-Target-URI out;
line breaks in a url are percent-encoded; repeated rows give one record each; a null page_id
is never the response that others refer to (its record revisits the smallest non-null id of its
payload if there is one, else it is a response); an empty table gives an empty archive; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.session import scratch, table

#: Smaller payloads are stored as responses even when repeated.
MIN_REVISIT_BYTES = 100
WARC_DATE = "1970-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
EOL = "\r\n"


def _record_id(page_id: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), F.coalesce(page_id.cast("string"), F.lit("null")), F.lit(">"))


def _header(page_id: Column, url: Column, digest: Column, size: Column, refers_to: Column) -> Column:
    """The exact header block of a record, ending with an empty line."""
    revisit = refers_to.isNotNull()
    clean = F.regexp_replace(F.regexp_replace(url, "\r", "%0D"), "\n", "%0A")
    lines = [
        F.lit("WARC/1.1"),
        F.concat(F.lit("WARC-Type: "), F.when(revisit, "revisit").otherwise("response")),
        F.concat(F.lit("WARC-Record-ID: "), _record_id(page_id)),
        F.lit(f"WARC-Date: {WARC_DATE}"),
        F.concat(F.lit("WARC-Target-URI: "), clean),  # null is left out by concat_ws
        F.concat(F.lit("WARC-Payload-Digest: sha256:"), F.lower(F.hex(digest))),
        F.when(revisit, F.lit(f"WARC-Profile: {PROFILE}")),
        F.when(revisit, F.concat(F.lit("WARC-Refers-To: "), _record_id(refers_to))),
        F.lit("Content-Type: text/html; charset=utf-8"),
        F.concat(F.lit("Content-Length: "), F.when(revisit, F.lit(0)).otherwise(size).cast("string")),
    ]
    return F.concat(F.concat_ws(EOL, *lines), F.lit(EOL + EOL))


def write_archive(pages: DataFrame, path: str) -> None:
    """Write one record per row of pages(page_id, url, html) as a content-addressed archive.

    Map-side aggregation keeps one payload per digest and task before the only shuffle that
    carries payloads, so a payload that fills a third of the rows costs a row per task.
    """
    spark = pages.sparkSession
    payload = F.encode(F.coalesce(F.col("html"), F.lit("")), "utf-8")
    keyed = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", payload.alias("payload")).withColumn("digest", F.unhex(F.sha2("payload", 256)))
    store = keyed.groupBy("digest").agg(F.any_value("payload").alias("payload"), F.min("page_id").alias("first_id"))
    store.write.parquet(f"{path}/payloads")
    firsts = spark.read.parquet(f"{path}/payloads").select("digest", "first_id")
    narrow = keyed.select("page_id", "url", "digest", F.octet_length("payload").cast("long").alias("size"))
    repeats = (F.col("size") >= MIN_REVISIT_BYTES) & F.col("first_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first_id"))
    records = narrow.join(firsts, "digest").withColumn("refers_to", F.when(repeats, F.col("first_id")))
    records.select("page_id", "digest", _header(F.col("page_id"), F.col("url"), F.col("digest"), F.col("size"), F.col("refers_to")).alias("header")).write.parquet(f"{path}/headers")


def _field(name: str) -> Column:
    """A header field's value, null if the record has none."""
    found = F.regexp_extract("header", rf"\r\n{name}: ([^\r]*)\r\n", 1)
    return F.when(found != "", found)


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """Read records back: page_id, header, payload and what the header says, with the payload verified.

    The digest is computed again from the stored bytes before the join; a payload whose bytes do
    not hash to its address raises. Columns that a caller does not use (payload) are pruned.
    """
    store = spark.read.parquet(f"{path}/payloads").select("digest", "payload")
    actual = F.unhex(F.sha2("payload", 256))
    store = store.select(
        "digest",
        "payload",
        F.octet_length("payload").cast("long").alias("payload_bytes"),
        F.when(actual == F.col("digest"), F.lower(F.hex(actual))).otherwise(F.raise_error(F.lit("stored payload does not match its digest"))).alias("payload_digest"),
    )
    said = spark.read.parquet(f"{path}/headers").select(
        "page_id",
        "digest",
        "header",
        _field("WARC-Type").alias("record_type"),
        F.regexp_extract(F.coalesce(_field("WARC-Refers-To"), F.lit("")), r"^<urn:page:(-?[0-9]+)>$", 1).alias("_refers"),
    )
    return said.join(store, "digest").select("page_id", "header", "payload", "payload_bytes", "payload_digest", "record_type", F.when(F.col("_refers") != "", F.col("_refers")).cast("long").alias("refers_to"))


def original_records(spark: SparkSession, path: str) -> DataFrame:
    """Each record as it would stand in one WARC file: header, block, two line ends; revisits have no block."""
    block = F.when(F.col("record_type") == "response", F.col("payload")).otherwise(F.encode(F.lit(""), "utf-8"))
    return read_archive(spark, path).select("page_id", F.concat(F.encode("header", "utf-8"), block, F.encode(F.lit(EOL + EOL), "utf-8")).alias("record"))


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark, "warc")
    write_archive(table(spark, sf_dir, "pages"), path)
    return read_archive(spark, path).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


OP4_SQL = """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS b FROM pages),
k AS (SELECT page_id, octet_length(b)::BIGINT AS payload_bytes, sha256(b) AS payload_digest FROM p),
f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first_id FROM k)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN payload_bytes >= 100 AND page_id <> first_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= 100 AND page_id <> first_id THEN first_id END AS refers_to
FROM f
"""
