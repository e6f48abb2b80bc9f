"""Queries of the knowledge store, of bundles in volumes, and of SQL with table functions, over the test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.operators import knowledge, release
from quarry.plans import corpus_queries, sqlapi, table_functions
from quarry.plans.register import registry
from quarry.session import scratch, table
from quarry.sources import markdown

QUERIES, ORACLES, query = registry()


def _two_runs(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """Parts as nodes with brand edges: a first run, verdicts of people, and a second run that lacks some, adds some and renames others."""
    part = table(spark, d, "part").select(F.concat(F.lit("p"), "p_partkey").alias("node"), F.col("p_name").alias("name"), "p_brand", "p_partkey")
    brands = part.select(F.col("p_brand").alias("node"), F.concat(F.lit("brand "), "p_brand").alias("name")).distinct()
    home = scratch(spark, "knowledge")
    for name, rest, named in (("r1", "p_partkey % 3 <> 0", F.col("name")), ("r2", "p_partkey % 4 <> 0", F.when(F.col("p_partkey") % 2 == 0, F.concat(F.lit("new "), "name")).otherwise(F.col("name")))):
        some = part.where(rest)
        nodes = some.select("node", named.alias("name")).unionByName(brands)
        knowledge.run(nodes, some.select(F.col("node").alias("src"), F.lit("of").alias("rel"), F.col("p_brand").alias("dst")), home, name, ["name"])
        if name == "r1":
            said = part.where("p_partkey % 5 = 0 OR p_partkey % 11 = 0").select("node", F.when(F.col("p_partkey") % 11 == 0, "rejected").otherwise("verified").alias("verification"))
            knowledge.verify(spark, home, said)
    return knowledge.read(spark, home)


_RUNS = """WITH p AS (SELECT *, p_partkey % 3 <> 0 AS one, p_partkey % 4 <> 0 AS two, CASE WHEN p_partkey % 3 <> 0 AND p_partkey % 11 = 0 THEN 'rejected' WHEN p_partkey % 3 <> 0 AND p_partkey % 5 = 0 THEN 'verified' ELSE 'unverified' END AS v,
  CASE WHEN p_partkey % 2 = 0 THEN 'new ' || p_name ELSE p_name END AS renamed FROM part WHERE p_partkey % 3 <> 0 OR p_partkey % 4 <> 0),
n AS (SELECT 'p' || p_partkey AS node, p_brand, one, two, v, CASE WHEN two AND (NOT one OR v = 'unverified') THEN renamed ELSE p_name END AS name,
  CASE WHEN v = 'rejected' THEN 'rejected' WHEN two OR v = 'verified' THEN 'active' ELSE 'retired' END AS status, CASE WHEN one AND two THEN 'r1,r2' WHEN one THEN 'r1' ELSE 'r2' END AS runs,
  CASE WHEN two AND one AND v <> 'unverified' AND renamed <> p_name THEN '{"name":"' || renamed || '"}' END AS conflict FROM p)
"""


@query(_RUNS + """SELECT node, name, status, v AS verification, runs, conflict, CASE status WHEN 'rejected' THEN 'verdict' WHEN 'retired' THEN 'r2' END AS closed_by FROM n
UNION ALL SELECT DISTINCT p_brand, 'brand ' || p_brand, 'active', 'unverified', 'r1,r2', NULL, NULL FROM part""")
def knowledge_nodes(spark: SparkSession, d: str) -> DataFrame:
    """Nodes after two runs with verdicts between."""
    nodes = _two_runs(spark, d)[0]
    return nodes.withColumn("runs", F.array_join("runs", ","))


@query(_RUNS + """SELECT node AS src, 'of' AS rel, p_brand AS dst, CASE WHEN two AND status = 'active' THEN 'active' ELSE 'closed' END AS status, runs,
  CASE WHEN two AND status = 'active' THEN NULL WHEN status = 'rejected' AND one THEN 'verdict' ELSE 'r2' END AS closed_by FROM n""")
def knowledge_edges(spark: SparkSession, d: str) -> DataFrame:
    """Relationships after two runs: closed where the second run lacks them or an end does not stand."""
    return _two_runs(spark, d)[1].select("src", "rel", "dst", "status", F.array_join("runs", ",").alias("runs"), "closed_by")


@query("""WITH d AS (SELECT source AS bundle, 'doc-' || doc_id || '.txt' AS name, coalesce(text, '') AS t FROM documents WHERE source IS NOT NULL),
s AS (SELECT bundle, greatest(1, ceil(sum(strlen(t)) / 200000.0))::BIGINT AS volumes FROM d GROUP BY bundle),
p AS (SELECT bundle, name, sha256(t) AS sha, strlen(t) AS size, ('0x' || substr(md5(name), 1, 8))::BIGINT % volumes AS volume FROM d JOIN s USING (bundle)),
v AS (SELECT bundle, volume, count(*) AS parts, sum(size)::BIGINT AS bytes, sha256(string_agg(name || ':' || sha, chr(10) ORDER BY name)) AS digest FROM p GROUP BY ALL)
SELECT bundle, volume, parts, bytes, digest, parts AS members FROM v""")
def bundle_volumes(spark: SparkSession, d: str) -> DataFrame:
    """Documents of a source as a bundle in volumes; each archive is opened again and its members counted."""
    docs = table(spark, d, "documents").where("source IS NOT NULL").select(F.col("source").alias("bundle"), F.concat(F.lit("doc-"), "doc_id", F.lit(".txt")).alias("name"), F.encode(F.coalesce("text", F.lit("")), "utf-8").alias("content"))
    volumes = release.volumes(docs, 200_000)
    return release.opened(volumes).groupBy("bundle", "volume", "parts", "bytes", "digest").agg(F.count("*").alias("members"))


@query(corpus_queries.ORACLES["page_links"])
def sql_table_function(spark: SparkSession, d: str) -> DataFrame:
    """Links of pages by a table function in guarded SQL."""
    table_functions.register(spark)
    sqlapi.publish(spark, {"pages": table(spark, d, "pages")}, {"pages": ["page_id", "html"]})
    return sqlapi.guarded(spark, "SELECT page_id, target, pos, label FROM v_pages, LATERAL page_links(html)")


@query("WITH t AS (SELECT conv_id, role, count(*) AS n FROM conversations GROUP BY conv_id, role) SELECT conv_id AS doc_key, role AS title, n FROM t")
def sql_section_function(spark: SparkSession, d: str) -> DataFrame:
    """Turns of conversations by role, from the headings of their bodies in guarded SQL."""
    table_functions.register(spark)
    sqlapi.publish(spark, {"bodies": markdown.conversation_bodies(table(spark, d, "conversations"))}, {"bodies": ["doc_key", "body"]})
    return sqlapi.guarded(spark, "SELECT doc_key, title, count(*) AS n FROM v_bodies, LATERAL body_sections(body) WHERE level = 2 GROUP BY doc_key, title")
