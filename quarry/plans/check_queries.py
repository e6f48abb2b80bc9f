"""Queries of checks, sinks and lookups, with their SQL."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.operators import checks, search
from quarry.session import scratch, ship, table


def doctor(spark: SparkSession, d: str) -> DataFrame:
    t = {n: table(spark, d, n) for n in ("orders", "customer", "lineitem", "labels", "documents", "nation")}
    return checks.report([
        checks.violations("orders_without_customer", checks.orphans(t["orders"], "o_custkey", t["customer"], "c_custkey")),
        checks.violations("lines_without_order", checks.orphans(t["lineitem"], "l_orderkey", t["orders"], "o_orderkey")),
        checks.violations("labels_without_document", checks.orphans(t["labels"], "doc_id", t["documents"], "doc_id")),
        checks.violations("unknown_status", checks.unknown_values(t["orders"], "o_orderstatus", ["F", "O"]), "WARN"),
        checks.violations("unknown_language", checks.unknown_values(t["documents"], "lang", ["de", "en", "es", "fr"])),
        checks.violations("empty_text", t["documents"].where("text IS NULL OR text = ''"), "WARN"),
        checks.violations("repeated_document", t["documents"].groupBy("doc_id").count().where("count > 1")),
    ])


def integrity(spark: SparkSession, d: str) -> DataFrame:
    part = table(spark, d, "part").select("p_partkey", F.sha2("p_name", 256).alias("digest"))
    present = part.where("p_partkey % 7 <> 0").select("p_partkey", F.when(F.col("p_partkey") % 5 == 0, F.lit("x")).otherwise(F.col("digest")).alias("digest"))
    return checks.bundle_integrity(part.where("p_partkey % 11 <> 0"), present, "p_partkey", "digest")


def digests(spark: SparkSession, d: str) -> DataFrame:
    return checks.bundle_digest(table(spark, d, "orders").withColumn("digest", F.sha2("o_orderpriority", 256)), "o_custkey", "o_orderkey", "digest")


def drops(spark: SparkSession, d: str) -> DataFrame:
    events = table(spark, d, "events")
    early, late = events.where("ts < TIMESTAMP '2024-01-16 00:00:00'"), events.where("ts >= TIMESTAMP '2024-01-16 00:00:00' AND event_type <> 'error'")
    return checks.count_drops(early, late, "event_type", 0.9)


def departed(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "customer")
    return checks.departures(c, c.where("c_custkey % 6 <> 0"), "c_custkey", "c_mktsegment", ["BUILDING"])


def actions_whole(spark: SparkSession, d: str) -> DataFrame:
    """Over all events, with conditions under which all actions occur: nearly every user has a purchase and three errors."""
    bought = (F.col("event_type") == "purchase") & (F.col("value") >= 150)
    return checks.fetch_state(table(spark, d, "events"), "user_id", bought, F.col("event_type") == "error", 14)


def retained_index(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders").select("o_orderkey", "o_orderstatus")
    return checks.retain(o.where("o_orderkey % 3 = 0"), o.where("o_orderkey % 2 = 0").withColumn("o_orderstatus", F.lit("old")), "o_orderkey")


def stored_payloads(spark: SparkSession, d: str) -> DataFrame:
    """Content-addressed names of pages, each once."""
    return table(spark, d, "pages").groupBy(F.concat(F.sha2("html", 256), F.lit(".html")).alias("name")).agg(F.min("page_id").alias("first"), F.count("*").alias("n"))


def csv_round_trip(spark: SparkSession, d: str) -> DataFrame:
    part = table(spark, d, "part").select("p_partkey", "p_name", F.concat(F.lit('a "quoted", '), "p_brand").alias("note"))
    path = scratch(spark, "csv")
    part.write.option("header", True).option("escape", '"').csv(path)
    return spark.read.schema(part.schema).option("header", True).option("escape", '"').csv(path)


def frontmatter(spark: SparkSession, d: str) -> DataFrame:
    """A block of keys in front of a body, written and taken apart again."""
    text = F.concat(F.lit("---\nbrand: "), "p_brand", F.lit("\nsize: "), F.col("p_size").cast("string"), F.lit("\n---\n"), "p_name")
    head = F.regexp_extract("text", r"(?s)^---\n(.*?)\n---\n", 1)
    meta = F.str_to_map(head, F.lit("\n"), F.lit(": "))
    rows = table(spark, d, "part").select("p_partkey", text.alias("text"))
    return rows.select("p_partkey", meta["brand"].alias("brand"), meta["size"].cast("int").alias("size"), F.regexp_replace("text", r"(?s)^---\n.*?\n---\n", "").alias("body"))


def newest_versions(spark: SparkSession, d: str) -> DataFrame:
    """The largest version of each brand, by numbers and not by text."""
    version = F.concat_ws(".", F.col("p_size").cast("string"), (F.col("p_partkey") % 100).cast("string"))
    key = F.transform(F.split("version", r"\."), lambda x: x.try_cast("int"))
    return table(spark, d, "part").select("p_brand", version.alias("version")).groupBy("p_brand").agg(F.max_by("version", key).alias("version"))


def url_multiplicity(spark: SparkSession, d: str) -> DataFrame:
    bare = F.regexp_replace("url", "[0-9]+", "0")
    return table(spark, d, "pages").groupBy(bare.alias("url")).agg(F.count("*").alias("n"), F.min("page_id").alias("first")).where("n > 1")


QUERIES = {
    "doctor_checks": doctor, "bundle_integrity": integrity, "bundle_digest": digests, "count_reconcile": drops, "composition_departures": departed,
    "fetch_actions_whole": actions_whole, "raw_index_retain": retained_index, "content_addressed_names": stored_payloads, "csv_round_trip": csv_round_trip, "frontmatter": frontmatter,
    "newest_versions": newest_versions, "url_multiplicity": url_multiplicity,
}

ORACLES = {
    "doctor_checks": """WITH c AS (SELECT 'orders_without_customer' AS name, count(*) AS violations, 'FAIL' AS bad FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer)
        UNION ALL SELECT 'lines_without_order', count(*), 'FAIL' FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders)
        UNION ALL SELECT 'labels_without_document', count(*), 'FAIL' FROM labels WHERE doc_id NOT IN (SELECT doc_id FROM documents)
        UNION ALL SELECT 'unknown_status', count(DISTINCT o_orderstatus), 'WARN' FROM orders WHERE o_orderstatus NOT IN ('F', 'O', '')
        UNION ALL SELECT 'unknown_language', count(DISTINCT lang), 'FAIL' FROM documents WHERE lang NOT IN ('de', 'en', 'es', 'fr', '')
        UNION ALL SELECT 'empty_text', count(*), 'WARN' FROM documents WHERE text IS NULL OR text = ''
        UNION ALL SELECT 'repeated_document', count(*), 'FAIL' FROM (SELECT doc_id FROM documents GROUP BY doc_id HAVING count(*) > 1))
        SELECT name, violations, CASE WHEN violations = 0 THEN 'PASS' ELSE bad END AS health FROM c""",
    "bundle_integrity": """WITH l AS (SELECT p_partkey, sha256(p_name) AS a FROM part WHERE p_partkey % 11 <> 0), r AS (SELECT p_partkey, CASE WHEN p_partkey % 5 = 0 THEN 'x' ELSE sha256(p_name) END AS b FROM part WHERE p_partkey % 7 <> 0)
        SELECT * FROM (SELECT p_partkey, CASE WHEN b IS NULL THEN 'missing' WHEN a IS NULL THEN 'extra' WHEN a <> b THEN 'mismatch' END AS finding FROM l FULL JOIN r USING (p_partkey)) WHERE finding IS NOT NULL""",
    "bundle_digest": "SELECT o_custkey, sha256(string_agg(o_orderkey || ':' || sha256(o_orderpriority), chr(10) ORDER BY o_orderkey || ':' || sha256(o_orderpriority))) AS digest FROM orders GROUP BY o_custkey",
    "count_reconcile": """WITH b AS (SELECT event_type, count(*) FILTER (ts < TIMESTAMP '2024-01-16') AS before, count(*) FILTER (ts >= TIMESTAMP '2024-01-16' AND event_type <> 'error') AS after FROM events GROUP BY event_type)
        SELECT *, CASE WHEN after = 0 THEN 'zero' WHEN after < 0.9 * before THEN 'drop' ELSE 'ok' END AS finding FROM b WHERE before > 0""",
    "composition_departures": "SELECT c_mktsegment, count(*) AS n FROM customer WHERE c_custkey % 6 = 0 AND c_mktsegment <> 'BUILDING' GROUP BY c_mktsegment",
    "raw_index_retain": "SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderkey % 3 = 0 UNION ALL SELECT o_orderkey, 'old' FROM orders WHERE o_orderkey % 2 = 0 AND o_orderkey % 3 <> 0",
    "content_addressed_names": "SELECT sha256(html) || '.html' AS name, min(page_id) AS first, count(*) AS n FROM pages GROUP BY html",
    "csv_round_trip": "SELECT p_partkey, p_name, 'a \"quoted\", ' || p_brand AS note FROM part",
    "frontmatter": "SELECT p_partkey, p_brand AS brand, p_size AS size, p_name AS body FROM part",
    "newest_versions": "SELECT p_brand, arg_max(p_size || '.' || (p_partkey % 100), [p_size, p_partkey % 100]) AS version FROM part GROUP BY p_brand",
    "url_multiplicity": "SELECT regexp_replace(url, '[0-9]+', '0', 'g') AS url, count(*) AS n, min(page_id) AS first FROM pages GROUP BY 1 HAVING count(*) > 1",
}
