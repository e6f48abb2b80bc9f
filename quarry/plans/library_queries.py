"""Queries of catalog enrichment, resolution, gates, chunking and stores over the test tables, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from quarry.functions import text as T
from quarry.operators import bodies, catalog, checks, chunking, mining, release, resolve, stores, versions, vocabulary
from quarry.plans import sqlapi, tools
from quarry.session import scratch, ship, table
from quarry.sources import markdown, registries

QUERIES: dict = {}
ORACLES: dict = {}


def query(sql: str | None = None):
    """Register a query under its function's name, with its SQL."""

    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


# Names, identities and titles


@query("""SELECT p_partkey, p_name || ' (' || upper(substr(p_type, 1, 3)) || ')' AS name, CASE p_size % 3 WHEN 0 THEN 'active' WHEN 1 THEN 'archive' ELSE 'decommissioned' END AS status,
    CASE WHEN p_size % 3 = 2 THEN 'Jan 20' || lpad((p_size % 20)::VARCHAR, 2, '0') ELSE '' END AS retired_on, upper(substr(p_type, 1, 3)) AS code FROM part""")
def app_names(spark: SparkSession, d: str) -> DataFrame:
    ending = F.when(F.col("p_size") % 3 == 0, "").when(F.col("p_size") % 3 == 1, " - Archive ").otherwise(F.concat(F.lit(" - DECOMMISSIONED Jan 20"), F.lpad((F.col("p_size") % 20).cast("string"), 2, "0")))
    raw = F.concat("p_name", F.lit(" ("), F.upper(F.substring("p_type", 1, 3)), F.lit(")"), ending)
    return table(spark, d, "part").select("p_partkey", catalog.app_name_parts(raw).alias("a")).select("p_partkey", "a.*")


def _region_pages(spark: SparkSession, d: str) -> DataFrame:
    """A page for each region: a link to each nation, twice, and one that is none of them."""
    link = F.concat(F.lit('<p><a class="x" href="list.asp?secid='), (F.col("n_nationkey") % 7).cast("string"), F.lit('&amp;v=1"><b>'), "n_name", F.lit("</b> &#38; co</a><a href='skip'>no</a><a href=\"other.asp?secid=1\">other</a>"))
    rows = table(spark, d, "nation").groupBy("n_regionkey").agg(F.sort_array(F.collect_list(F.struct("n_nationkey", link.alias("l")))).alias("x"))
    return rows.select("n_regionkey", F.array_join(F.transform("x", lambda e: e["l"]), "\n").alias("html"))


@query("""SELECT n_regionkey, (n_nationkey % 7)::VARCHAR AS entry, 'list.asp?secid=' || n_nationkey % 7 || '&amp;v=1' AS url, n_name || ' & co' AS name
    FROM (SELECT *, row_number() OVER (PARTITION BY n_regionkey, n_nationkey % 7 ORDER BY n_nationkey) AS r FROM nation) WHERE r = 1""")
def page_entries(spark: SparkSession, d: str) -> DataFrame:
    return catalog.linked_entries(_region_pages(spark, d), "n_regionkey", "list.asp", "secid")


@query("""WITH s AS (SELECT s_suppkey, s_name, s_nationkey % 4 AS k FROM supplier)
    SELECT s_suppkey, 1::BIGINT AS row, 'docs/' || s_suppkey || '.pdf?x=1' AS url, s_name AS title, 'PDF' AS label, '2019-12' AS said_on FROM s WHERE k <> 3
    UNION ALL SELECT s_suppkey, 2, 'docs/' || s_suppkey || '.docx', 'The ' || s_name, 'Guide', NULL FROM s WHERE k <> 3
    UNION ALL SELECT s_suppkey, 1, s_suppkey || '.TXT', 'bare ' || s_name, '', NULL FROM s WHERE k = 3""")
def page_files(spark: SparkSession, d: str) -> DataFrame:
    key, name = F.col("s_suppkey").cast("string"), F.col("s_name")
    rows = F.concat(F.lit("<table><tr><td>lone</td></tr><tr><td><a href=\"docs/"), key, F.lit(".pdf?x=1\">pdf</a></td><td>"), name, F.lit("</td><td>Dec 2019</td></tr><tr><th>Guide</th><td><a href=\"docs/"), key, F.lit(".docx\">The "), name, F.lit("</a> <a href=\"x.html\">no</a></td></tr></table>"))
    bare = F.concat(F.lit("<a href=\"index.html\">home</a><p><a href=\""), key, F.lit(".TXT\">bare "), name, F.lit("</a>"))
    html = F.when(F.col("s_nationkey") % 4 == 3, bare).otherwise(rows)
    return catalog.file_rows(table(spark, d, "supplier").select("s_suppkey", html.alias("html")), "s_suppkey")


@query("SELECT r_name AS section, n_name AS app, s_name AS doc, s_suppkey AS number FROM region JOIN nation ON n_regionkey = r_regionkey JOIN supplier ON s_nationkey = n_nationkey")
def hierarchy_flatten(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "supplier").groupBy("s_nationkey").agg(F.collect_list(F.struct(F.col("s_name").alias("doc"), F.col("s_suppkey").alias("number"))).alias("docs"))
    apps = table(spark, d, "nation").join(docs, F.col("n_nationkey") == F.col("s_nationkey")).groupBy("n_regionkey").agg(F.collect_list(F.struct(F.col("n_name").alias("app"), "docs")).alias("apps"))
    return catalog.flatten(table(spark, d, "region").join(apps, F.col("r_regionkey") == F.col("n_regionkey")).select(F.col("r_name").alias("section"), "apps"))


@query("""SELECT p_partkey AS number, CASE p_size % 3 WHEN 0 THEN 'docx' WHEN 1 THEN 'pdf' ELSE '' END AS doc_format, CASE p_size % 3 WHEN 0 THEN '' WHEN 1 THEN 'format pdf' ELSE 'format unknown' END AS out_of_scope_reason FROM part""")
def json_records(spark: SparkSession, d: str) -> DataFrame:
    said = F.when(F.col("p_size") % 3 == 0, "docx").when(F.col("p_size") % 3 == 1, "pdf").otherwise("")
    texts = table(spark, d, "part").select(F.to_json(F.struct(F.col("p_partkey").alias("number"), said.alias("doc_format"), F.col("p_name").alias("unknown_key"))).alias("line"))
    return catalog.read_records(texts, "line", StructType([StructField("number", LongType()), StructField("doc_format", StringType())]))


_SLUG = "lower(replace(p_brand, '#', '')) || '_5_' || p_size || '_p' || p_partkey || CASE WHEN p_size % 2 = 0 THEN '_Rev_guide' ELSE '' END"
_STEM = "lower(replace(p_brand, '#', '')) || CASE WHEN p_size % 2 = 0 THEN '_guide' ELSE '' END"
_KIND = "CASE WHEN p_size % 5 = 0 THEN '' ELSE 'UG' END"


@query(f"""WITH p AS (SELECT p_partkey, {_SLUG} AS slug, {_STEM} AS stem, {_KIND} AS kind FROM part)
    SELECT p_partkey, 'A/B:' || slug AS doc_id, stem, CASE WHEN kind = '' THEN '' ELSE 'A/B:PK:UG:' || stem END AS anchor, 'A_B/' || slug AS bundle,
    CASE WHEN kind = '' THEN 'A_B/' || slug ELSE 'A_B/' || stem END AS folder, 'gold/' || CASE WHEN kind = '' THEN 'A_B/' || slug ELSE 'A_B/' || stem END || '/body.md' AS body FROM p""")
def identities(spark: SparkSession, d: str) -> DataFrame:
    slug = F.concat(F.lower(F.replace("p_brand", F.lit("#"), F.lit(""))), F.lit("_5_"), "p_size", F.lit("_p"), "p_partkey", F.when(F.col("p_size") % 2 == 0, "_Rev_guide").otherwise(""))
    rows = table(spark, d, "part").select("p_partkey", F.lit("A/B").alias("app"), F.lit("PK").alias("pkg"), F.when(F.col("p_size") % 5 == 0, "").otherwise("UG").alias("kind"), slug.alias("slug"))
    parts = (F.col("app"), F.col("pkg"), F.col("kind"), F.col("slug"))
    folder = catalog.anchor_path(*parts)
    return rows.select("p_partkey", catalog.doc_id(F.col("app"), F.col("slug")).alias("doc_id"), catalog.slug_stem(F.col("slug")).alias("stem"), catalog.anchor_key(*parts).alias("anchor"), catalog.bundle_path(F.col("app"), F.col("slug")).alias("bundle"), folder.alias("folder"), catalog.body_path(folder).alias("body"))


@query("SELECT p_partkey, CASE WHEN p_brand = 'Brand#11' THEN 'first' WHEN p_brand = 'Brand#12' THEN 'second' ELSE p_brand END AS p_brand FROM part")
def anchor_aliases(spark: SparkSession, d: str) -> DataFrame:
    names = spark.createDataFrame([("Brand#11", "first"), ("Brand#12", "second"), ("none", "x")], "key string, name string")
    return catalog.with_alias(table(spark, d, "part").select("p_partkey", "p_brand"), "p_brand", names).select("p_partkey", "p_brand")


@query("""SELECT p_partkey, CASE WHEN p_size % 4 = 0 THEN 'unclassified' WHEN p_size % 4 = 1 THEN 'Server + GUI + cots' ELSE 'Server' END AS system,
    CASE WHEN p_size % 4 = 0 THEN 'unclassified' ELSE 'Server' END AS platform, CASE WHEN p_size % 4 = 1 THEN 2 ELSE 0 END::BIGINT AS companions, p_size % 4 = 1 OR p_size = 7 AS bought FROM part""")
def system_types(spark: SparkSession, d: str) -> DataFrame:
    sizes = table(spark, d, "part").select("p_size").distinct().where("p_size % 4 <> 0")
    systems = sizes.select(F.col("p_size").cast("string").alias("app"), F.when(F.col("p_size") % 4 == 1, "Server + GUI + cots").otherwise("Server").alias("system"))
    rows = catalog.classify_system(table(spark, d, "part").select("p_partkey", F.col("p_size").cast("string").alias("app")), "app", systems, ["7"])
    parts = catalog.system_parts(F.col("system"))
    return rows.select("p_partkey", "system", parts["platform"].alias("platform"), F.size(parts["companions"]).cast("long").alias("companions"), "bought")


@query("""SELECT o_orderkey, CASE o_orderkey % 3 WHEN 0 THEN strftime(o_orderdate, '%Y-%m') WHEN 1 THEN '12/2019' ELSE '' END AS said FROM orders""")
def normal_dates(spark: SparkSession, d: str) -> DataFrame:
    raw = F.when(F.col("o_orderkey") % 3 == 0, F.concat(F.lit(" "), F.upper(F.date_format("o_orderdate", "MMM yyyy")))).when(F.col("o_orderkey") % 3 == 1, "12/2019")
    return table(spark, d, "orders").select("o_orderkey", catalog.normal_date(raw).alias("said"))


@query("""SELECT page_id, CASE WHEN page_id % 4 = 0 THEN 'form' WHEN page_id % 4 = 1 THEN '' ELSE 'reference' END AS noise FROM pages""")
def noise_kinds(spark: SparkSession, d: str) -> DataFrame:
    url = F.when(F.col("page_id") % 4 == 0, "https://Forms.example.org/library/a.pdf").when(F.col("page_id") % 4 == 1, "https://www.example.org/library/a.pdf?x=1").otherwise("https://www.example.org/docs/?from=/library/")
    return table(spark, d, "pages").select("page_id", catalog.noise_kind(url, ["forms.example.org"], "/library/").alias("noise"))


@query("""WITH r AS (SELECT p_partkey, 'http://x/' || p_partkey // 3 || CASE p_partkey % 3 WHEN 0 THEN '.docx' WHEN 1 THEN '.pdf' ELSE '.pdf' END AS url, p_partkey // 3 AS base, CASE p_partkey % 3 WHEN 0 THEN 'docx' ELSE 'pdf' END AS e FROM part)
    SELECT p_partkey, (SELECT min(b.url) FROM r b WHERE b.base = a.base AND b.e <> a.e) AS companion FROM r a""")
def companion_files(spark: SparkSession, d: str) -> DataFrame:
    url = F.concat(F.lit("http://x/"), F.floor(F.col("p_partkey") / 3), F.when(F.col("p_partkey") % 3 == 0, ".docx").otherwise(".pdf"))
    return catalog.companions(table(spark, d, "part").select("p_partkey", url.alias("url")), "p_partkey", "url")


_TYPES = [("(?i)^promo", "PM"), ("(?i)brass$", "BG"), ("(?i)polished|plated", "PG")]


@query("""SELECT p_partkey, CASE WHEN p_type ILIKE 'promo%' THEN 'PM' WHEN p_type ILIKE '%brass' THEN 'BG' WHEN regexp_matches(p_type, '(?i)polished|plated') THEN 'PG' WHEN p_size % 2 = 0 THEN 'UG' ELSE '' END AS kind FROM part""")
def doc_types(spark: SparkSession, d: str) -> DataFrame:
    file = F.concat(F.lit("guide_"), "p_partkey", F.when(F.col("p_size") % 2 == 0, "_UG.docx").otherwise("_zz.docx"))
    return table(spark, d, "part").select("p_partkey", catalog.doc_type(F.col("p_type"), file, _TYPES, {"ug": "UG", "tm": "TM"}).alias("kind"))


@query("SELECT p_partkey, CASE WHEN p_size % 3 = 0 THEN '' ELSE p_name END AS subject FROM part")
def subjects(spark: SparkSession, d: str) -> DataFrame:
    said = F.when(F.col("p_size") % 6 == 0, "2019").when(F.col("p_size") % 3 == 0, "5.3 ").otherwise(F.col("p_name"))
    title = F.concat(F.lit("AB*5.3*12  - "), said, F.lit(", User Guide "))
    return table(spark, d, "part").select("p_partkey", catalog.subject(title, F.lit("AB*5.3*12"), F.lit("User Guide")).alias("subject"))


@query("SELECT p_partkey, CASE WHEN p_brand = 'Brand#11' THEN 'Eleven' ELSE p_type END AS label, CASE WHEN p_brand = 'Brand#11' THEN p_type ELSE '' END AS subtitle FROM part")
def canonical_labels(spark: SparkSession, d: str) -> DataFrame:
    labels = spark.createDataFrame([("Brand#11", "Eleven")], "kind string, name string")
    return catalog.canonical_labels(table(spark, d, "part").select("p_partkey", F.col("p_brand").alias("kind"), F.col("p_type").alias("label")), "kind", "label", labels).select("p_partkey", "label", "subtitle")


@query("""SELECT p_partkey, CASE WHEN p_size % 2 = 0 THEN 'clerk' END AS app_user, CASE WHEN p_size % 3 = 0 THEN 'reader' WHEN p_size % 3 = 1 AND p_size % 2 = 0 THEN 'clerk' END AS doc_user FROM part""")
def profile_tags(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "part").select("p_partkey", (F.col("p_size") % 2).cast("string").alias("app"), (F.col("p_size") % 3).cast("string").alias("kind"))
    by_app = spark.createDataFrame([("0", "clerk"), ("1", "")], "app string, user string")
    by_kind = spark.createDataFrame([("0", "reader"), ("1", "operator")], "kind string, user string")
    return catalog.profile_tags(rows, "app", "kind", by_app, by_kind).select("p_partkey", F.col("tags")["app_user"].alias("app_user"), F.col("tags")["doc_user"].alias("doc_user"))


@query("""SELECT p_partkey, concat_ws(';', CASE WHEN p_size % 2 = 0 THEN 'brand=' || p_brand END, 'kind=' || p_type) AS head,
    CASE p_size % 4 WHEN 0 THEN 'how-to' WHEN 1 THEN 'tutorial' ELSE 'reference' END AS mode FROM part""")
def identity_frontmatter(spark: SparkSession, d: str) -> DataFrame:
    meta = catalog.frontmatter_of(brand=F.when(F.col("p_size") % 2 == 0, F.col("p_brand")).otherwise(""), kind=F.col("p_type"), none=F.lit(None))
    head = F.array_join(F.transform(F.array_sort(F.map_entries(meta)), lambda e: F.concat(e["key"], F.lit("="), e["value"])), ";")
    code = F.when(F.col("p_size") % 4 == 0, "ug").when(F.col("p_size") % 4 == 1, "TRG").when(F.col("p_size") % 4 == 2, "??")
    return table(spark, d, "part").select("p_partkey", head.alias("head"), catalog.reading_mode(code).alias("mode"))


@query("SELECT p_partkey, p_size % 2 = 0 OR p_brand = 'Brand#11' AS layout FROM part")
def converter_routing(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "part").select("p_partkey", catalog.needs_layout_converter(F.when(F.col("p_size") % 2 == 0, "PDF").otherwise("docx"), F.col("p_brand"), ["Brand#11"]).alias("layout"))


@query("SELECT page_id, page_id % 3 = 0 AS zip FROM pages")
def payload_magic(spark: SparkSession, d: str) -> DataFrame:
    content = F.when(F.col("page_id") % 3 == 0, F.concat(F.lit(b"PK\x03\x04"), F.encode("html", "utf-8"))).otherwise(F.encode("html", "utf-8"))
    return table(spark, d, "pages").select("page_id", catalog.is_zip(content).alias("zip"))


@query("""WITH s AS (SELECT c_nationkey, string_agg(DISTINCT c_mktsegment, ',' ORDER BY c_mktsegment) AS m, string_agg(DISTINCT substr(c_name, 1, 3), ',' ORDER BY substr(c_name, 1, 3)) AS n FROM customer GROUP BY c_nationkey)
    SELECT c_nationkey, sha256(CASE WHEN c_nationkey % 5 = 0 THEN 'all' ELSE 'some' END || chr(10) || 'name=' || n || chr(10) || 'segment=' || m) AS digest FROM s""")
def selection_fingerprints(spark: SparkSession, d: str) -> DataFrame:
    """A selection for each nation: the market segments and name prefixes of its customers, of every fifth nation besides everything."""
    told = table(spark, d, "customer").groupBy("c_nationkey").agg(F.collect_set("c_mktsegment").alias("m"), F.collect_set(F.substring("c_name", 1, 3)).alias("n"))
    return told.select("c_nationkey", catalog.selection_digest(F.col("c_nationkey") % 5 == 0, segment=F.col("m"), name=F.concat("n", "n")).alias("digest"))


# Inventory joins and counts


@query("""WITH o AS (SELECT o_custkey, o_orderkey, o_orderpriority, o_orderstatus <> 'F' AS scope FROM orders),
    r AS (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY scope DESC, o_orderkey) AS n FROM o)
    SELECT o_custkey, o_orderpriority, CASE WHEN NOT scope THEN 'out_of_scope' ELSE coalesce(c_mktsegment, 'not_acquired') END AS status FROM r LEFT JOIN (SELECT * FROM customer WHERE c_custkey % 3 <> 0) ON c_custkey = o_custkey WHERE n = 1""")
def inventory_status(spark: SparkSession, d: str) -> DataFrame:
    got = table(spark, d, "customer").where("c_custkey % 3 <> 0").select(F.col("c_custkey").alias("o_custkey"), F.col("c_mktsegment").alias("status"))
    return catalog.inventory_status(table(spark, d, "orders"), "o_custkey", F.col("o_orderstatus") != "F", "o_orderkey", ["o_orderpriority"], got)


@query("""SELECT 'total' AS status, count(*) AS n, 1::BIGINT AS place FROM orders UNION ALL SELECT o_orderstatus, count(*), CASE o_orderstatus WHEN 'O' THEN 2 ELSE 3 END FROM orders WHERE o_orderstatus IN ('O', 'F') GROUP BY o_orderstatus""")
def status_summary(spark: SparkSession, d: str) -> DataFrame:
    return catalog.status_summary(table(spark, d, "orders").select(F.col("o_orderstatus").alias("status")), ["O", "F", "never"])


@query("""SELECT p_brand, count(*) FILTER (p_size % 7 <> 0) AS genuine, count(*) FILTER (p_size % 7 <> 0 AND starts_with(p_type, 'S') AND p_size > 5) AS admitted,
    count(*) FILTER (p_size % 7 <> 0 AND NOT starts_with(p_type, 'S')) AS out_of_scope, count(*) FILTER (p_size % 7 <> 0 AND starts_with(p_type, 'S') AND p_size <= 5) AS omitted FROM part GROUP BY ROLLUP (p_brand)""")
def gate_summary(spark: SparkSession, d: str) -> DataFrame:
    return catalog.gate_summary(table(spark, d, "part"), "p_brand", F.col("p_size") % 7 != 0, F.col("p_type").startswith("S"), F.col("p_size") > 5)


@query("""WITH f AS (SELECT 'lang' AS facet, lang AS value, count(*) AS n FROM documents WHERE lang <> '' GROUP BY lang UNION ALL SELECT 'source', source, count(*) FROM documents WHERE source <> '' GROUP BY source)
    SELECT *, row_number() OVER (PARTITION BY facet ORDER BY n DESC, value) AS place FROM f""")
def facet_catalog(spark: SparkSession, d: str) -> DataFrame:
    return catalog.facet_catalog(table(spark, d, "documents"), ["lang", "source"])


@query("""SELECT 'documents' AS name, '' AS value, count(*) AS n FROM documents UNION ALL SELECT 'pages', '', count(*) FROM pages UNION ALL SELECT 'events', event_type, count(*) FROM events GROUP BY event_type""")
def corpus_counts(spark: SparkSession, d: str) -> DataFrame:
    return catalog.counts({"documents": table(spark, d, "documents"), "pages": table(spark, d, "pages")}, {"events": (table(spark, d, "events"), "event_type")})


@query("SELECT lang, count(*) AS n FROM documents GROUP BY ROLLUP (lang)")
def crawl_yield(spark: SparkSession, d: str) -> DataFrame:
    return catalog.crawl_yield(table(spark, d, "documents"), "lang")


@query("""SELECT o_custkey, o_orderkey, o_orderpriority FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderstatus = 'O' DESC, o_orderkey) AS r FROM orders) WHERE r = 1 AND o_custkey IN (SELECT c_custkey FROM customer)""")
def records_by_bundle(spark: SparkSession, d: str) -> DataFrame:
    """Each bundle's record, an open one before the first, joined to the bundles that are there."""
    one = catalog.preferred(table(spark, d, "orders").select("o_custkey", "o_orderkey", "o_orderpriority", "o_orderstatus"), "o_custkey", F.col("o_orderstatus") == "O", "o_orderkey")
    return one.join(table(spark, d, "customer").select(F.col("c_custkey").alias("o_custkey")), "o_custkey", "left_semi").select("o_custkey", "o_orderkey", "o_orderpriority")


@query("""SELECT doc_id, source || '/' || lang || '/body.md' AS path FROM (SELECT *, row_number() OVER (PARTITION BY source, lang ORDER BY n_chars DESC NULLS LAST, doc_id DESC) AS r FROM documents) WHERE r = 1""")
def latest_paths(spark: SparkSession, d: str) -> DataFrame:
    rows = versions.lineage(table(spark, d, "documents").select("doc_id", "source", "lang", "n_chars"), ["source", "lang"], ["n_chars"], "doc_id")
    return rows.where("is_latest").select("doc_id", F.concat_ws("/", "source", "lang", F.lit("body.md")).alias("path"))


@query("""WITH c AS (SELECT strftime(o_orderdate, '%Y-%m-%d') AS day, o_orderkey, row_number() OVER (PARTITION BY strftime(o_orderdate, '%Y-%m-%d') ORDER BY o_orderkey) AS n FROM orders) SELECT o_orderkey, day || CASE WHEN n > 1 THEN '-' || n ELSE '' END AS name FROM c""")
def snapshot_names(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "orders").select("o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd").alias("day"))
    return versions.snapshot_names(rows, "day", "o_orderkey").select("o_orderkey", "name")


@query("""SELECT user_id, event_id FROM (SELECT user_id, event_id, event_type, lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS p FROM events) WHERE p IS NULL OR p <> event_type""")
def kept_snapshots(spark: SparkSession, d: str) -> DataFrame:
    return versions.changed_snapshots(table(spark, d, "events"), "user_id", ["ts", "event_id"], "event_type").select("user_id", "event_id")


@query("""SELECT regexp_extract(url, '^[a-zA-Z]+://([^/?#]+)', 1) AS host, sha256(string_agg(url || chr(9) || sha256(html), chr(10) ORDER BY url || chr(9) || sha256(html))) AS digest FROM pages GROUP BY 1""")
def tree_hashes(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "pages").select(F.regexp_extract("url", r"^[a-zA-Z]+://([^/?#]+)", 1).alias("host"), "url", "html")
    return checks.tree_hash(rows, "host", "url", "html")


@query("""SELECT o_custkey, count(*) AS n, min(strftime(o_orderdate, '%Y-%m')) FILTER (o_orderkey % 4 <> 0) AS first, max(strftime(o_orderdate, '%Y-%m')) FILTER (o_orderkey % 4 <> 0) AS last FROM orders GROUP BY o_custkey""")
def revision_summary(spark: SparkSession, d: str) -> DataFrame:
    said = F.when(F.col("o_orderkey") % 4 == 0, "undated").otherwise(F.date_format("o_orderdate", "yyyy-MM"))
    return versions.revision_summary(table(spark, d, "orders").select("o_custkey", said.alias("said")), "o_custkey", "said")


# Terms and entities

_FOUND = r"""WITH m AS (SELECT l_orderkey AS doc, CASE WHEN l_linenumber % 3 = 0 THEN 'file' WHEN l_linenumber % 3 = 1 THEN 'name' ELSE 'root' END AS type,
    CASE WHEN l_linenumber % 3 = 0 THEN (l_partkey % 50)::VARCHAR WHEN l_linenumber % 3 = 1 THEN 'Part ' || l_partkey % 40 ELSE 'par' END AS surface FROM lineitem)"""
_NODES = "n AS (SELECT 'n' || p AS node, p::VARCHAR AS number, 'PART ' || p AS name FROM (SELECT unnest(range(1, 30)) AS p))"


def _found(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    k = F.col("l_linenumber") % 3
    surface = F.when(k == 0, (F.col("l_partkey") % 50).cast("string")).when(k == 1, F.concat(F.lit("Part "), (F.col("l_partkey") % 40).cast("string"))).otherwise("par")
    found = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("doc"), F.when(k == 0, "file").when(k == 1, "name").otherwise("root").alias("type"), surface.alias("surface"))
    p = F.col("id").cast("string")
    nodes = spark.range(1, 30).select(F.concat(F.lit("n"), p).alias("node"), p.alias("number"), F.array(F.concat(F.lit("part  "), p), F.lit("")).alias("surfaces"))
    return resolve.resolve_mentions(found, nodes, "file", "root")


@query(f"{_FOUND}, {_NODES} SELECT DISTINCT doc, node, surface FROM m JOIN n ON (type = 'file' AND surface = number) OR upper(surface) = name")
def resolved_mentions(spark: SparkSession, d: str) -> DataFrame:
    return _found(spark, d)[0]


@query(f"""{_FOUND}, {_NODES}, r AS (SELECT m.*, node, n.name IS NOT NULL AND upper(surface) = n.name AS named FROM m LEFT JOIN n ON (type = 'file' AND surface = number) OR upper(surface) = name),
    u AS (SELECT * FROM r WHERE node IS NULL AND NOT (type = 'root' AND doc IN (SELECT doc FROM r WHERE named)))
    SELECT type, surface, count(*) AS occurrences, count(DISTINCT doc) AS documents, array_to_string(list_slice(list_sort(list(DISTINCT doc)), 1, 5), ',') AS docs FROM u GROUP BY type, surface""")
def resolution_proposals(spark: SparkSession, d: str) -> DataFrame:
    return resolve.proposals(_found(spark, d)[1]).withColumn("docs", F.concat_ws(",", F.col("docs").cast("array<string>")))


@query(f"""{_FOUND}, {_NODES} SELECT DISTINCT node AS src, 'documented-in' AS rel, 'doc/' || doc AS dst FROM m JOIN n ON (type = 'file' AND surface = number) OR upper(surface) = name""")
def documented_in(spark: SparkSession, d: str) -> DataFrame:
    return resolve.partition_edges(resolve.documented_in(_found(spark, d)[0]), ["documented-in"])[0]


@query("""SELECT 'n' || n_nationkey AS node, n_name AS surface, 'canonical_name' AS kind FROM nation UNION ALL SELECT 'n' || n_nationkey, lower(n_name), 'synonym' FROM nation UNION ALL SELECT 'n' || n_nationkey, 'land ' || n_regionkey, 'synonym' FROM nation""")
def synonym_rows(spark: SparkSession, d: str) -> DataFrame:
    return resolve.synonym_rows(_nation_nodes(spark, d))


@query("SELECT 'n' || n_nationkey AS node, 'land ' || n_regionkey AS surface FROM nation UNION ALL SELECT 'n' || n_nationkey, n_name FROM nation WHERE regexp_matches(n_name, '[0-9]|\\S\\s+\\S') UNION ALL SELECT 'n' || n_nationkey, lower(n_name) FROM nation WHERE regexp_matches(n_name, '[0-9]|\\S\\s+\\S')")
def tagging_surfaces(spark: SparkSession, d: str) -> DataFrame:
    return resolve.tagging_surfaces(_nation_nodes(spark, d))


def _nation_nodes(spark: SparkSession, d: str) -> DataFrame:
    more = F.array("n_name", F.lower("n_name"), F.lower("n_name"), F.lit(""), F.concat(F.lit("land "), F.col("n_regionkey").cast("string")))
    return table(spark, d, "nation").select(F.concat(F.lit("n"), F.col("n_nationkey").cast("string")).alias("node"), F.col("n_name").alias("name"), more.alias("synonyms"), F.lit("nation").alias("type"), F.col("n_nationkey").cast("string").alias("canonical"))


@query("SELECT 'n' || n_nationkey AS node, 'nation:' || n_nationkey AS entity_id FROM nation WHERE n_nationkey IN (SELECT s_nationkey FROM supplier)")
def reconciled_nodes(spark: SparkSession, d: str) -> DataFrame:
    entities = table(spark, d, "supplier").select(F.concat(F.lit("nation:"), F.col("s_nationkey").cast("string")).alias("entity_id"))
    return resolve.reconcile_nodes(_nation_nodes(spark, d), entities).select("node", "entity_id")


_PRODUCTS = """WITH p AS (SELECT p_brand AS abbr, p_type AS full_name, split_part(p_name, ' ', 1) > 'h' AS e, split_part(p_name, ' ', 1) AS m, 'c' || p_size % 3 AS k FROM part),
    x AS (SELECT abbr, abbr AS surface, e, k FROM p UNION ALL SELECT abbr, full_name, true, k FROM p UNION ALL SELECT abbr, upper(m), e, k FROM p UNION ALL SELECT abbr, upper(substr(m, 1, 1)) || substr(m, 2), e, k FROM p),
    t AS (SELECT surface, bool_and(e) AS enforce FROM x GROUP BY surface), w AS (SELECT DISTINCT split_part(p_name, ' ', 1) AS word FROM part WHERE p_partkey % 2 = 0),
    r AS (SELECT surface, enforce, lower(surface) IN (SELECT word FROM w) AND NOT (regexp_matches(surface, '[A-Z]') AND regexp_matches(surface, '[a-z]') AND surface <> upper(substr(surface, 1, 1)) || lower(substr(surface, 2))) AS collides FROM t)"""


def _terms(spark: SparkSession, d: str) -> DataFrame:
    first = F.split("p_name", " ")[0]
    part = table(spark, d, "part")
    products = part.select(F.col("p_brand").alias("abbr"), F.col("p_type").alias("full"), F.array(F.upper(first), F.concat(F.upper(F.substring(first, 1, 1)), F.substr(first, F.lit(2)))).alias("match"), (first > "h").alias("enforce"), F.lit("c").alias("class"))
    return resolve.classify_terms(products, part.where("p_partkey % 2 = 0").select(first.alias("word")))


@query(f"{_PRODUCTS} SELECT surface, enforce, collides FROM r")
def classified_terms(spark: SparkSession, d: str) -> DataFrame:
    return _terms(spark, d).select("surface", "enforce", "collides")


@query(f"{_PRODUCTS} SELECT surface FROM r WHERE NOT contains(surface, ' ') AND enforce AND NOT collides")
def casing_swaps(spark: SparkSession, d: str) -> DataFrame:
    return resolve.casing_swaps(_terms(spark, d))


@query("""WITH v AS (SELECT p_brand AS type, upper(p_name) AS name FROM part WHERE p_partkey % 2 = 0), e AS (SELECT p_brand AS type, p_name AS canonical FROM part),
    c AS (SELECT type, count(*) AS total, count(*) FILTER ((type, upper(canonical)) IN (SELECT (type, name) FROM v)) AS joined FROM e GROUP BY type)
    SELECT type, CASE type WHEN 'Brand#11' THEN 'waived' WHEN 'Brand#12' THEN 'UNDECLARED' ELSE 'floor-verified' END AS status, total, CASE WHEN type IN ('Brand#11', 'Brand#12') THEN 0 ELSE joined END AS joined,
    CASE WHEN type IN ('Brand#11', 'Brand#12') THEN 0.0 ELSE round(joined / total, 4) END AS rate, CASE type WHEN 'Brand#11' THEN true WHEN 'Brand#12' THEN false ELSE round(joined / total, 4) >= 0.5 END AS ok FROM c
    UNION ALL SELECT 'empty', 'floor-verified', 0, 0, 1.0, true""")
def entity_quality(spark: SparkSession, d: str) -> DataFrame:
    part = table(spark, d, "part")
    kinds = part.select(F.col("p_brand").alias("type")).distinct().where("type <> 'Brand#12'").unionByName(spark.createDataFrame([("empty",)], "type string"))
    policy = kinds.select("type", F.when(F.col("type") == "Brand#11", "waived").otherwise("floor-verified").alias("status"), F.lit(0.5).alias("floor"))
    return resolve.entity_quality(part.select(F.col("p_brand").alias("type"), F.col("p_name").alias("canonical")), part.where("p_partkey % 2 = 0").select(F.col("p_brand").alias("type"), F.col("p_name").alias("name")), policy)


@query("SELECT 'T' || n_nationkey AS term, n_name AS definition FROM nation WHERE n_regionkey <> 2")
def acronym_pairs(spark: SparkSession, d: str) -> DataFrame:
    head = F.when(F.col("n_regionkey") == 2, F.array(F.lit("Key"), F.lit("Value"))).otherwise(F.array(F.lit("Acronym"), F.lit("Meaning")))
    row = F.array(F.concat(F.lit(" T"), F.col("n_nationkey").cast("string")), F.col("n_name"))
    rows = F.array(head, row, F.array(F.lit(""), F.lit("x")), F.array(F.lit("same"), F.lit("Same")), F.array(F.lit("lone")), F.array(F.repeat(F.lit("long"), F.lit(9)), F.lit("y")))
    return resolve.acronym_pairs(table(spark, d, "nation").select(rows.alias("rows")))


@query("""WITH c AS (SELECT upper(p_brand) AS t, p_brand AS term, p_type AS definition, count(*) AS n FROM part GROUP BY ALL), b AS (SELECT *, row_number() OVER (PARTITION BY t ORDER BY n DESC, term DESC, definition DESC) AS r FROM c)
    SELECT string_agg('- **' || term || '**: ' || definition, chr(10) ORDER BY t) AS text FROM b WHERE r = 1""")
def glossary_text(spark: SparkSession, d: str) -> DataFrame:
    return resolve.glossary_text(table(spark, d, "part").select(F.col("p_brand").alias("term"), F.col("p_type").alias("definition")))


# Gates


@query("SELECT DISTINCT event_type FROM events WHERE event_type NOT IN ('view', 'click')")
def undeclared_types(spark: SparkSession, d: str) -> DataFrame:
    return checks.undeclared(table(spark, d, "events"), spark.createDataFrame([("view",), ("click",), ("other",)], "event_type string"), "event_type")


@query("""WITH c AS (SELECT 'one_to_one' AS "check", abs(count(*) - 777) AS violations FROM part UNION ALL SELECT 'noise_kind', count(*) FILTER (p_size % 9 = 8) FROM part UNION ALL SELECT 'some_genuine', 0 UNION ALL SELECT 'has_p_name', count(*) FILTER (p_name IS NULL OR p_name = '') FROM part UNION ALL SELECT 'has_kind', count(*) FILTER (p_size = 3) FROM part)
    SELECT "check", violations, violations = 0 AS ok FROM c""")
def inventory_gate(spark: SparkSession, d: str) -> DataFrame:
    noise = F.when(F.col("p_size") % 9 == 8, "odd").when(F.col("p_size") % 9 == 7, "form").otherwise("")
    rows = table(spark, d, "part").select("p_partkey", "p_name", noise.alias("noise"), F.when(F.col("p_size") != 3, "k").alias("kind"))
    return checks.inventory_gate(rows, "p_partkey", "noise", ["", "form"], ["p_name", "kind"], 777)


@query("""WITH s AS (SELECT p_partkey, CASE p_size % 5 WHEN 0 THEN NULL WHEN 1 THEN 'QUARANTINE' WHEN 2 THEN 'REVIEW' ELSE 'PASS' END AS v, p_partkey % 3 = 0 AS signed FROM part),
    f AS (SELECT p_partkey, CASE WHEN v IS NULL THEN 'unscored' WHEN v = 'QUARANTINE' THEN 'quarantined' WHEN v = 'REVIEW' AND NOT signed THEN 'review_unsigned' WHEN v = 'PASS' AND signed THEN 'signoff_stale' END AS finding FROM s UNION ALL SELECT -3, 'signoff_stale')
    SELECT p_partkey, finding, finding <> 'signoff_stale' AS blocks FROM f WHERE finding IS NOT NULL""")
def retention_gate(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("p_size") % 5
    scored = table(spark, d, "part").select("p_partkey", F.when(k == 1, "QUARANTINE").when(k == 2, "REVIEW").when(k > 2, "PASS").alias("verdict"))
    signed = scored.where("p_partkey % 3 = 0").select("p_partkey").unionByName(spark.createDataFrame([(-3,)], "p_partkey long"))
    return checks.retention_gate(scored, "p_partkey", signed)


@query("""WITH m AS (SELECT o_custkey, o_orderkey, o_orderkey % 2 = 1 AS is_latest, CASE WHEN o_orderkey % 5 = 0 THEN '' ELSE sha256(o_custkey::VARCHAR) END AS s FROM orders),
    c AS (SELECT c_custkey, count(*) FILTER (is_latest) AS n, max(s) FILTER (is_latest) AS r FROM customer LEFT JOIN m ON o_custkey = c_custkey GROUP BY c_custkey)
    SELECT c_custkey AS o_custkey, CASE WHEN n <> 1 OR r = '' THEN 'unverifiable' ELSE 'stale' END AS finding FROM c WHERE n <> 1 OR r = '' OR r <> sha256(CASE WHEN c_custkey % 4 = 0 THEN 'x' ELSE c_custkey::VARCHAR END)""")
def lineage_check(spark: SparkSession, d: str) -> DataFrame:
    key = F.col("o_custkey").cast("string")
    members = table(spark, d, "orders").select("o_custkey", (F.col("o_orderkey") % 2 == 1).alias("is_latest"), F.when(F.col("o_orderkey") % 5 == 0, "").otherwise(F.sha2(key, 256)).alias("body_sha256"))
    bodies = table(spark, d, "customer").select(F.col("c_custkey").alias("o_custkey"), F.when(F.col("c_custkey") % 4 == 0, "x").otherwise(F.col("c_custkey").cast("string")).alias("body"))
    return checks.lineage_check(members, "o_custkey", bodies)


@query("SELECT count(*) FILTER (event_type = 'error') AS errors, count(*) AS total, count(*) FILTER (event_type = 'error') <= 0.5 * count(*) AS ok FROM events")
def error_gate(spark: SparkSession, d: str) -> DataFrame:
    return checks.error_gate(table(spark, d, "events").select(F.when(F.col("event_type") == "error", "failed").alias("error")), "error")


@query("""SELECT 'view part missing' AS problem UNION ALL SELECT 'view region not in contract' UNION ALL SELECT 'version ' || count(*) || ' instead of 0' FROM supplier
    UNION ALL SELECT 'view nation: columns [' || (SELECT string_agg(chr(39) || column_name || chr(39), ', ') FROM (DESCRIBE nation)) || '] instead of [''n_name'', ''n_nationkey'']'""")
def contract_check(spark: SparkSession, d: str) -> DataFrame:
    """The tables as views against a contract that names another set, other columns and another version."""
    emitted = {t: table(spark, d, t).columns for t in ("nation", "region", "supplier")}
    want = {"nation": ["n_name", "n_nationkey"], "part": ["p_partkey"], "supplier": emitted["supplier"]}
    found = checks.contract_problems(emitted, str(table(spark, d, "supplier").count()), {"version": "0", "views": want})
    return spark.createDataFrame([(p,) for p in found], "problem string")


# Chunks


@query("SELECT p_partkey, CASE WHEN p_size % 3 = 0 THEN p_name WHEN contains(lower(p_name), lower(split_part(p_name, ' ', 1))) AND p_size % 3 = 1 THEN p_name ELSE 'Zed ' || p_name END AS title FROM part")
def folded_titles(spark: SparkSession, d: str) -> DataFrame:
    app = F.when(F.col("p_size") % 3 == 0, "  ").when(F.col("p_size") % 3 == 1, F.upper(F.split("p_name", " ")[0])).otherwise(" Zed ")
    return table(spark, d, "part").select("p_partkey", chunking.folded_title(app, F.col("p_name")).alias("title"))


@query("SELECT p_partkey, 'table-0' || p_size % 9 || '.csv|' || p_name || ';table-77.csv|x' AS refs FROM part")
def table_refs(spark: SparkSession, d: str) -> DataFrame:
    body = F.concat(F.lit("see _["), "p_name", F.lit(" (extracted to CSV)](tables/table-0"), (F.col("p_size") % 9).cast("string"), F.lit(".csv)_ and [y](tables/table-1.csv)\n_[x (extracted to CSV)](tables/table-77.csv)_"))
    refs = chunking.table_refs(body)
    return table(spark, d, "part").select("p_partkey", F.array_join(F.transform(refs, lambda r: F.concat(r["name"], F.lit("|"), r["caption"])), ";").alias("refs"))


def _order_tables(spark: SparkSession, d: str) -> DataFrame:
    """A table of line items for each order."""
    row = F.array(F.col("l_linenumber").cast("string"), F.lit("  "), F.concat(F.lit(" "), "l_returnflag"), F.col("l_partkey").cast("string"))
    return table(spark, d, "lineitem").groupBy("l_orderkey").agg(F.array_sort(F.collect_list(F.struct("l_linenumber", "l_partkey", row.alias("row")))).alias("x")).select("l_orderkey", F.concat(F.array(F.array(F.lit(" "), F.lit(""))), F.transform("x", lambda e: e["row"])).alias("rows"))


@query("""SELECT l_orderkey, md5('Lines' || chr(10) || string_agg(l_linenumber || ' |  | ' || l_returnflag || ' | ' || l_partkey, chr(10) ORDER BY l_linenumber, l_partkey, l_returnflag)) AS digest FROM lineitem GROUP BY l_orderkey""")
def table_texts(spark: SparkSession, d: str) -> DataFrame:
    return _order_tables(spark, d).select("l_orderkey", F.md5(chunking.table_text(F.lit(" Lines "), F.col("rows"))).alias("digest"))


@query()
def table_windows(spark: SparkSession, d: str) -> DataFrame:
    cut = chunking.table_windows(F.lit("Lines"), F.col("rows"), 40, 60)
    return _order_tables(spark, d).select("l_orderkey", F.posexplode(cut).alias("part", "text"))


def _line_sections(spark: SparkSession, d: str) -> DataFrame:
    """Lines of documents as sections: ten to a path, the first of a path without one, blank ones not searchable."""
    each = table(spark, d, "documents").select("doc_id", F.posexplode(F.split("text", "\n", -1)).alias("seq", "text"))
    return each.select("doc_id", F.col("seq").cast("long").alias("seq"), F.concat_ws("/", F.col("doc_id").cast("string"), F.col("seq").cast("string")).alias("section_id"), F.concat(F.lit("t"), F.col("seq").cast("string")).alias("title"), F.when(F.col("seq") % 10 == 0, "").otherwise(F.concat(F.lit("p"), F.floor(F.col("seq") / 10).cast("string"))).alias("path"), "text", (F.trim("text") != "").alias("searchable"))


@query()
def chunk_units(spark: SparkSession, d: str) -> DataFrame:
    units = chunking.chunk_units(_line_sections(spark, d), "doc_id")
    return units.select("doc_id", "section_id", "path", F.md5("text").alias("digest"), F.size("members").cast("long").alias("members"))


@query()
def unit_chunks(spark: SparkSession, d: str) -> DataFrame:
    cut = chunking.chunks_for_units(chunking.chunk_units(_line_sections(spark, d), "doc_id", merge=False).select("doc_id", "section_id", "text"))
    return cut.select("doc_id", "chunk_id", F.length("chunk").cast("long").alias("n"))


_PROFILE_BODY = """SELECT doc_key, body || chr(10) || '```' || chr(10) || '# not one' || chr(10) || '| a | b |' || chr(10) || '```' || chr(10) || '| a | b |' || chr(10) || '| c | d |' || chr(10) || '### Deep' || chr(10) || '| e |' || chr(10) || '![i](x.png) <IMG src=y> [l](#a) ^ABC $$GET^X <table >' AS body
    FROM (SELECT conv_id AS doc_key, '# Conversation ' || conv_id || chr(10) || string_agg('## ' || role || chr(10) || coalesce(text, ''), chr(10) ORDER BY turn) AS body FROM conversations GROUP BY conv_id)"""


@query(rf"""WITH b AS ({_PROFILE_BODY}), l AS (SELECT doc_key, i, x[i] AS line FROM (SELECT doc_key, x, unnest(range(1, len(x) + 1)) AS i FROM (SELECT doc_key, string_split(body, chr(10)) AS x FROM b))),
    f AS (SELECT *, regexp_matches(line, '^\s*(```+|~~~+)') AS fence FROM l), o AS (SELECT *, coalesce(sum(fence::INT) OVER (PARTITION BY doc_key ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) % 2 = 1 AS fenced FROM f),
    p AS (SELECT *, NOT fence AND NOT fenced AND regexp_matches(line, '^\s*\|.*\|\s*$') AS pipe, CASE WHEN NOT fence AND NOT fenced THEN length(regexp_extract(line, '^(#{{1,6}})\s+\S', 1)) ELSE 0 END AS level FROM o),
    q AS (SELECT *, pipe AND NOT coalesce(lag(pipe) OVER (PARTITION BY doc_key ORDER BY i), false) AS begins FROM p),
    g AS (SELECT doc_key, count(*) FILTER (level > 0) AS headings, count(DISTINCT nullif(level, 0)) AS heading_levels, max(level)::BIGINT AS heading_depth, count(*) FILTER (fence AND NOT fenced) AS code_blocks, count(*) FILTER (fenced AND NOT fence) AS code_lines, count(*) FILTER (begins) AS tables_gfm FROM q GROUP BY doc_key)
    SELECT g.*, len(regexp_extract_all(body, '\S+'))::BIGINT AS words, len(regexp_extract_all(body, '(?i)<table\b'))::BIGINT AS tables_html, (len(regexp_extract_all(body, '!\[[^\]]*\]\([^)]*\)')) + len(regexp_extract_all(body, '(?i)<img\b')))::BIGINT AS images,
    len(regexp_extract_all(body, '\[[^\]]*\]\(#[^)]*\)'))::BIGINT AS internal_links, len(regexp_extract_all(body, '\^%?[A-Z][A-Z0-9]{{1,7}}\b|\$\$[A-Z0-9]+\^'))::BIGINT AS code_refs FROM g JOIN b USING (doc_key)""")
def document_profiles(spark: SparkSession, d: str) -> DataFrame:
    tail = "\n```\n# not one\n| a | b |\n```\n| a | b |\n| c | d |\n### Deep\n| e |\n![i](x.png) <IMG src=y> [l](#a) ^ABC $$GET^X <table >"
    return chunking.document_profile(markdown.conversation_bodies(table(spark, d, "conversations")).withColumn("body", F.concat("body", F.lit(tail))))


# Stores


@query("SELECT p_partkey, CASE WHEN p_partkey % 2 = 0 THEN 'second' ELSE p_name END AS p_name FROM part")
def store_swap(spark: SparkSession, d: str) -> DataFrame:
    """A table written, written again unchanged (skipped) and then changed; what readers see at the end."""
    home = scratch(spark, "store")
    part = table(spark, d, "part").select("p_partkey", "p_name")
    if not stores.replace_table(part, home) or stores.replace_table(part, home):
        raise RuntimeError("an equal table was written again")
    stores.replace_table(part.withColumn("p_name", F.when(F.col("p_partkey") % 2 == 0, "second").otherwise(F.col("p_name"))), home)
    return stores.read_table(spark, home)


@query("""WITH u AS (SELECT user_id, ts, event_type, event_id % 2 AS fresh, event_id FROM events) SELECT user_id, max(ts) AS ts FROM u GROUP BY user_id""")
def state_upsert(spark: SparkSession, d: str) -> DataFrame:
    events = table(spark, d, "events").select("user_id", "ts", "event_type", "event_id")
    old = stores.upsert(events.limit(0), events.where("event_id % 2 = 0"), "user_id", "ts")
    return stores.upsert(old, events.where("event_id % 2 = 1"), "user_id", "ts").select("user_id", "ts")


@query("SELECT p_partkey, p_brand IN (SELECT p_brand FROM part WHERE p_size > 45) AS stays FROM part")
def stale_prune(spark: SparkSession, d: str) -> DataFrame:
    part = table(spark, d, "part")
    stays, goes = stores.prune(part.select("p_partkey", "p_brand"), part.where("p_size > 45"), "p_brand")
    return stays.select("p_partkey", F.lit(True).alias("stays")).unionByName(goes.select("p_partkey", F.lit(False).alias("stays")))


@query("SELECT DISTINCT sha256(html) || '.html' AS name FROM pages WHERE sha256(html) NOT IN (SELECT sha256(html) FROM pages WHERE page_id % 3 = 0)")
def unreferenced_content(spark: SparkSession, d: str) -> DataFrame:
    pages = table(spark, d, "pages")
    told = pages.where("page_id % 3 = 0").select(F.concat(F.lit("body: "), F.upper(F.sha2("html", 256)), F.lit(".html")).alias("t"))
    return stores.unreferenced(stores.put_content(pages, "html", "html"), told, "t")


@query("""SELECT CASE WHEN p_size % 4 = 0 THEN NULL ELSE p_brand END AS asset, count(DISTINCT p_partkey) AS documents FROM part WHERE p_partkey % 2 = 0 GROUP BY 1""")
def asset_plan(spark: SparkSession, d: str) -> DataFrame:
    """Assets that a subset of documents needs, each once, with how many need it; null counts what is not there."""
    part = table(spark, d, "part").where("p_partkey % 2 = 0")
    there = part.select("p_partkey", "p_brand").join(part.where("p_size % 4 <> 0").select("p_partkey", F.col("p_brand").alias("asset")), "p_partkey", "left")
    return there.groupBy("asset").agg(F.countDistinct("p_partkey").alias("documents"))


@query("""SELECT n_regionkey, '| Key | Name |' || chr(10) || '| --- | --- |' || chr(10) || string_agg('| ' || n_nationkey || ' | ' || n_name || '\\|x |', chr(10) ORDER BY n_nationkey) AS body FROM nation GROUP BY n_regionkey""")
def gfm_tables(spark: SparkSession, d: str) -> DataFrame:
    row = F.array(F.col("n_nationkey").cast("string"), F.concat("n_name", F.lit("|x")), F.lit("over"))
    rows = table(spark, d, "nation").groupBy("n_regionkey").agg(F.array_sort(F.collect_list(F.struct("n_nationkey", row.alias("r")))).alias("x"))
    return rows.select("n_regionkey", T.gfm_table(F.concat(F.array(F.array(F.lit("Key"), F.lit("Name"))), F.transform("x", lambda e: e["r"]))).alias("body"))


# Patterns


@query(r"""WITH l AS (SELECT doc_id, unnest(string_split(CASE doc_id % 3 WHEN 0 THEN 'NOTE: ' WHEN 1 THEN 'Note: ' ELSE 'tip: ' END || text, chr(10))) AS line FROM documents), k AS (SELECT doc_id, upper(regexp_extract(line, '^([A-Za-z]+):', 1)) AS label, regexp_extract(line, '^([A-Za-z]+):', 1) AS variant FROM l),
    v AS (SELECT label, variant, count(DISTINCT doc_id) AS n FROM k WHERE label <> '' GROUP BY label, variant), r AS (SELECT *, row_number() OVER (PARTITION BY label ORDER BY n DESC, variant) AS p FROM v), d AS (SELECT label, count(DISTINCT doc_id) AS documents FROM k WHERE label <> '' GROUP BY label)
    SELECT label, documents, string_agg(variant || ' ' || n, ',' ORDER BY p) FILTER (p <= 8) AS variants FROM r JOIN d USING (label) WHERE documents >= 3 GROUP BY label, documents""")
def structure_labels(spark: SparkSession, d: str) -> DataFrame:
    label = F.when(F.col("doc_id") % 3 == 0, "NOTE: ").when(F.col("doc_id") % 3 == 1, "Note: ").otherwise("tip: ")
    docs = table(spark, d, "documents").select("doc_id", F.concat(label, F.col("text")).alias("text"))
    return mining.structures(docs, r"^([A-Za-z]+):").select("label", "documents", F.array_join(F.transform("variants", lambda v: F.concat(v["variant"], F.lit(" "), v["n"].cast("string"))), ",").alias("variants"))


@query("""WITH s AS (SELECT conv_id, role, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS i FROM conversations), t AS (SELECT conv_id AS doc_key, list(role ORDER BY i) AS r FROM s GROUP BY conv_id)
    SELECT doc_key, sha256(array_to_string(list_concat(['conversation ' || doc_key], r), chr(10))) AS fingerprint, (len(list_distinct(list_transform(range(1, len(r)), lambda i: r[i] || ' › ' || r[i + 1]))) + 1)::BIGINT AS shingles FROM t""")
def structural_fingerprints(spark: SparkSession, d: str) -> DataFrame:
    found = markdown.sections(markdown.conversation_bodies(table(spark, d, "conversations")))
    titles = found.groupBy("doc_key").agg(F.transform(F.array_sort(F.collect_list(F.struct("seq", "title"))), lambda t: t["title"]).alias("titles"))
    return titles.select("doc_key", mining.structural_fingerprint(F.col("titles")).alias("fingerprint"), F.size(mining.scaffold_shingles(F.col("titles"))).cast("long").alias("shingles"))


@query(r"""SELECT doc_id, len(regexp_extract_all(text || chr(10) || '1.' || chr(10) || ' - ', '(?m)^[ \t]*(?:[0-9]+\.|[-*])[ \t]*$'))::BIGINT AS bare, (length(text) - length(replace(text, '[[', '')))::BIGINT // 2 AS wraps FROM documents""")
def conversion_markers(spark: SparkSession, d: str) -> DataFrame:
    body = F.concat("text", F.lit("\n1.\n - "))
    return table(spark, d, "documents").select("doc_id", mining.bare_markers(body).alias("bare"), mining.cross_wraps(F.col("text")).alias("wraps"))


@query("""WITH t AS (SELECT doc_id, text || repeat(chr(10) || '- ' || chr(10) || '[[x]]', (doc_id % 120)::INTEGER) AS t FROM documents WHERE text IS NOT NULL),
    c AS (SELECT doc_id, ((length(t) - length(replace(t, '[[', ''))) // 2)::BIGINT AS wraps, len(regexp_extract_all(t, '(?m)^[ \\t]*(?:[0-9]+\\.|[-*])[ \\t]*$'))::BIGINT AS bare FROM t)
    SELECT doc_id, wraps, bare, 'layout' AS suggested, wraps || ' wraps of cross-references broke lists into ' || bare || ' bare markers' AS reason FROM c WHERE wraps >= 50""")
def routing_advice(spark: SparkSession, d: str) -> DataFrame:
    """Documents with, by their number, more or fewer of the marks that a broken conversion leaves."""
    marks = F.repeat(F.lit("\n- \n[[x]]"), (F.col("doc_id") % 120).cast("int"))
    return mining.routing_advice(table(spark, d, "documents").select("doc_id", F.concat("text", marks).alias("text")))


@query()
def boilerplate_clusters(spark: SparkSession, d: str) -> DataFrame:
    return mining.boilerplate_clusters(table(spark, d, "documents")).select(F.md5("block").alias("block"), "documents", "spellings", "grade")


@query("""WITH m AS (SELECT p_brand, p_type, p_size % 50 AS v FROM part), c AS (SELECT p_brand, count(*) AS n FROM m GROUP BY p_brand) SELECT p_brand, p_type, count(*) AS n, count(*) >= 0.5 * max(c.n) AS required FROM m JOIN c USING (p_brand) GROUP BY p_brand, p_type HAVING count(*) >= greatest(2, ceil(0.25 * max(c.n)))""")
def template_titles(spark: SparkSession, d: str) -> DataFrame:
    return mining.shared_titles(table(spark, d, "part").select("p_brand", "p_partkey", "p_type"), "p_brand", "p_partkey", "p_type").select("p_brand", "p_type", "n", "required")


# Bodies


def _built_bodies(spark: SparkSession, d: str) -> DataFrame:
    """A body for each order, by parts that are known: a revision history, a table of its lines, headings with bookmarks."""
    line = F.concat(F.lit("| "), F.col("l_linenumber").cast("string"), F.lit(" | a \\| b | "), "l_returnflag", F.lit(" |"))
    lines = table(spark, d, "lineitem").groupBy("l_orderkey").agg(F.sort_array(F.collect_set(line)).alias("rows")).select("l_orderkey", F.array_join(F.concat("rows", F.transform(F.sequence(F.lit(10), F.lit(17)), lambda i: F.concat(F.lit("| "), i.cast("string"), F.lit(" | x | y |")))), "\n").alias("rows"))
    orders = table(spark, d, "orders").select(F.col("o_orderkey").alias("l_orderkey"), F.date_format("o_orderdate", "MM/dd/yyyy").alias("day"))
    body = F.concat(
        F.lit("# Order\n\n## Revision History\n\n<table><tr><th>Date</th><th>Version</th><th>Description</th></tr><tr><td>"), "day", F.lit("</td><td>1.0</td><td>made &amp; sent</td></tr></table>\n\n"),
        F.lit('<span id="_Toc7"></span>\n## Lines\n\n| No | What | Flag |\n|---|---|---|\n'), "rows", F.lit("\n\n## Lines\n\nsee [lines](#_Toc7) and [none](#_Ref9)\n```\n# no heading\n```\n### Deep: end?\n"),
    )
    return orders.join(lines, "l_orderkey").select("l_orderkey", body.alias("body"))


def _rows_of(bodies_of: DataFrame, each, schema: str, copies: bool = True) -> DataFrame:
    """Rows that a plain function gives for each body, by Arrow batches. Where there may be copies, each text is worked through once;
    equal 128-bit digests are equal texts."""
    import pyarrow as pa

    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    ship(bodies_of.sparkSession)
    names = [c.split(" ")[0] for c in schema.split(", ")]
    mark, kind = ("_mark", "binary") if copies else (names[0], schema.split(", ")[0].split(" ")[1])
    told = f"{mark} {kind}, " + schema.split(", ", 1)[1]
    made = to_arrow_schema(StructType.fromDDL(told))

    def run(batches):
        for batch in batches:
            found = [each(b) for b in batch.column("body").to_pylist()]
            at = pa.array([i for i, rows in enumerate(found) for _ in rows], pa.int64())
            columns = list(zip(*(row for rows in found for row in rows), strict=True)) or [()] * (len(made) - 1)
            yield pa.RecordBatch.from_arrays([batch.column(mark).take(at).cast(made.field(0).type), *(pa.array(c, f.type) for c, f in zip(columns, list(made)[1:], strict=True))], schema=made)

    if not copies:
        return bodies_of.mapInArrow(run, told)
    digest = F.unhex(F.md5("body")).alias(mark)
    once = bodies_of.select("body").distinct().select(digest, "body").mapInArrow(run, told)
    return bodies_of.select(names[0], digest).join(once, mark).select(*names)


_ORDERS_WITH_LINES = "(SELECT DISTINCT l_orderkey FROM lineitem)"


@query(f"""SELECT l_orderkey, h.title, h.slug, h.level, h.bookmark FROM {_ORDERS_WITH_LINES}, (VALUES ('Order', 'order', 1, NULL), ('Revision History', 'revision-history', 2, NULL), ('Lines', 'lines', 2, '_Toc7'), ('Lines', 'lines-1', 2, NULL), ('Deep: end?', 'deep-end', 3, NULL)) h(title, slug, level, bookmark)""")
def body_headings(spark: SparkSession, d: str) -> DataFrame:
    return _rows_of(_built_bodies(spark, d), lambda b: [(h.text, h.slug, h.level, h.bookmark) for h in bodies.headings(b)], "l_orderkey long, title string, slug string, level int, bookmark string")


@query("""WITH r AS (SELECT l_orderkey, count(DISTINCT l_linenumber || l_returnflag) + 8 AS n FROM lineitem GROUP BY l_orderkey), s AS (SELECT DISTINCT l_orderkey, '| ' || l_linenumber || ' | a \\| b | ' || l_returnflag || ' |' AS k, l_linenumber || ',a | b,' || l_returnflag AS line FROM lineitem)
    SELECT l_orderkey, 'table-01.csv' AS name, (n + 1)::BIGINT AS n_rows, sha256('No,What,Flag' || chr(10) || (SELECT string_agg(line, chr(10) ORDER BY k) FROM s WHERE s.l_orderkey = r.l_orderkey) || chr(10) || (SELECT string_agg(i || ',x,y', chr(10) ORDER BY i) FROM range(10, 18) t(i)) || chr(10)) AS digest FROM r WHERE n + 1 >= 10""")
def body_tables(spark: SparkSession, d: str) -> DataFrame:
    import hashlib

    return _rows_of(_built_bodies(spark, d), lambda b: [(t.name, len(t.rows), hashlib.sha256(t.text.encode()).hexdigest()) for t in bodies.large_tables(b)], "l_orderkey long, name string, n_rows long, digest string")


@query(f"""SELECT o_orderkey AS l_orderkey, strftime(o_orderdate, '%Y-%m') AS said, '1.0' AS version, 'made & sent' AS description FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM {_ORDERS_WITH_LINES})""")
def body_revisions(spark: SparkSession, d: str) -> DataFrame:
    return _rows_of(_built_bodies(spark, d), lambda b: [(r["date"], r["version"], r["description"]) for r in bodies.revisions(b)[0]], "l_orderkey long, said string, version string, description string")


@query(f"""SELECT l_orderkey, t.bookmark, t.target FROM {_ORDERS_WITH_LINES}, (VALUES ('_Toc7', 'lines'), ('_Ref9', 'UNRESOLVED')) t(bookmark, target)""")
def body_links(spark: SparkSession, d: str) -> DataFrame:
    """Where links to bookmarks lead, by the headings of the same body."""
    return _rows_of(_built_bodies(spark, d), lambda b: sorted(bodies.link_targets(b, {h.bookmark: h.slug for h in bodies.headings(b) if h.bookmark}).items()), "l_orderkey long, bookmark string, target string")


@query(f"""SELECT l_orderkey, 0 AS comments, 0 AS bookmarks, 0 AS large_tables, 0 AS revision_tables FROM {_ORDERS_WITH_LINES}""")
def body_audit(spark: SparkSession, d: str) -> DataFrame:
    """What is left in bodies after their tables, revisions and links were taken: nothing."""

    def each(b: str) -> list[tuple]:
        slugs = {"_Toc7": "lines", "_Ref9": "order"}
        left = bodies.audit(bodies.rewrite_links(bodies.extract_tables(bodies.extract_revisions(b)[0])[0], slugs)[0])
        return [tuple(left[k] for k in ("comments", "bookmarks", "large_tables", "revision_tables"))]

    return _rows_of(_built_bodies(spark, d), each, "l_orderkey long, comments int, bookmarks int, large_tables int, revision_tables int")


# Recipes, cards and lists


def _published(spark: SparkSession, d: str) -> None:
    """Views of the test tables in the shape that the recipes ask for."""
    o, p = table(spark, d, "orders"), table(spark, d, "part")
    docs = o.select(F.col("o_orderkey").cast("string").alias("doc_key"), F.concat(F.lit("Order "), "o_orderkey").alias("title"), F.col("o_orderpriority").alias("kind"), F.col("o_orderstatus").alias("app"), F.year("o_orderdate").alias("year"), (F.col("o_orderkey") % 2 == 0).alias("is_latest"))
    lines = table(spark, d, "lineitem")
    mentions = lines.select(F.col("l_orderkey").cast("string").alias("doc_key"), F.concat(F.lit("part:"), "l_partkey").alias("entity_id"))
    entities = mentions.groupBy("entity_id").agg(F.count("*").alias("mentions")).join(p.select(F.concat(F.lit("part:"), "p_partkey").alias("entity_id"), F.col("p_brand").alias("type"), F.col("p_name").alias("name")), "entity_id")
    chunks = lines.select(F.col("l_orderkey").cast("string").alias("section_id"), F.col("l_linenumber").alias("part"), F.concat_ws(" ", "l_returnflag", "l_linestatus").alias("text"))
    nodes = _nation_nodes(spark, d)
    meta = spark.createDataFrame([("schema_version", "1")], "key string, value string")
    tables = {"documents": docs, "mentions": mentions, "entities": entities, "chunks": chunks, "nodes": nodes.select("node", "name"), "synonyms": resolve.synonym_rows(nodes), "meta": meta}
    sqlapi.publish(spark, tables, {k: v.columns for k, v in tables.items()})


@query("SELECT o_orderkey::VARCHAR AS doc_key, 'Order ' || o_orderkey AS title, o_orderpriority AS kind, o_orderstatus AS app, year(o_orderdate)::INT AS year FROM orders WHERE o_orderkey % 2 = 0 AND o_orderstatus = 'O' AND o_orderpriority = '1-URGENT'")
def recipe_filter_documents(spark: SparkSession, d: str) -> DataFrame:
    _published(spark, d)
    return tools.recipe(spark, "filter_documents", app="O", kind="1-URGENT")


@query("""WITH m AS (SELECT 'part:' || l_partkey AS entity_id, l_partkey, count(*) AS mentions FROM lineitem GROUP BY l_partkey) SELECT entity_id, p_brand AS type, p_name AS name, mentions FROM m JOIN part ON p_partkey = l_partkey WHERE p_brand = 'Brand#11' AND p_name LIKE '%e%' ORDER BY mentions DESC, entity_id LIMIT 20""")
def recipe_entity_lookup(spark: SparkSession, d: str) -> DataFrame:
    _published(spark, d)
    return tools.recipe(spark, "entity_lookup", type="Brand#11", name="%e%", k=20)


@query("SELECT DISTINCT l_orderkey::VARCHAR AS doc_key, 'Order ' || l_orderkey AS title FROM lineitem WHERE l_partkey = 7 AND l_orderkey IN (SELECT o_orderkey FROM orders)")
def recipe_entity_documents(spark: SparkSession, d: str) -> DataFrame:
    _published(spark, d)
    return tools.recipe(spark, "entity_documents", entity_id="part:7")


@query("SELECT l_returnflag || ' ' || l_linestatus AS text FROM lineitem WHERE l_orderkey = 3")
def recipe_section_text(spark: SparkSession, d: str) -> DataFrame:
    _published(spark, d)
    return tools.recipe(spark, "section_text", section_id="3")


@query("SELECT x.surface, x.kind FROM (SELECT n_name, unnest([{'surface': n_name, 'kind': 'canonical_name'}, {'surface': lower(n_name), 'kind': 'synonym'}, {'surface': 'land ' || n_regionkey, 'kind': 'synonym'}]) AS x FROM nation WHERE n_nationkey = 3)")
def recipe_synonyms(spark: SparkSession, d: str) -> DataFrame:
    _published(spark, d)
    name = table(spark, d, "nation").where("n_nationkey = 3").first()["n_name"]
    return tools.recipe(spark, "synonyms", name=name)


@query("""WITH r AS (SELECT *, row_number() OVER (PARTITION BY p_brand ORDER BY p_name) AS i, count(*) OVER (PARTITION BY p_brand) AS n FROM part)
    SELECT p_brand, n, '## ' || p_brand || ' (' || n || ')' || chr(10) || string_agg('- ' || p_name, chr(10) ORDER BY p_name) FILTER (i <= 5) || CASE WHEN n > 5 THEN chr(10) || '- and ' || (n - 5) || ' more' ELSE '' END AS card FROM r GROUP BY p_brand, n""")
def corpus_cards(spark: SparkSession, d: str) -> DataFrame:
    return release.corpus_card(table(spark, d, "part"), "p_brand", "p_name")


@query("SELECT 'nation' AS kind, n_nationkey::VARCHAR AS code, n_name AS label FROM nation UNION ALL SELECT 'region', r_regionkey::VARCHAR, r_name FROM region")
def vocabulary_rows(spark: SparkSession, d: str) -> DataFrame:
    nation = table(spark, d, "nation").select(F.col("n_nationkey").cast("string").alias("code"), F.col("n_name").alias("label"))
    region = table(spark, d, "region").select(F.col("r_regionkey").cast("string").alias("code"), F.col("r_name").alias("label"))
    return release.vocabulary_rows(nation=nation.unionByName(nation), region=region)


@query(f"{_PRODUCTS}, a AS (SELECT DISTINCT unnest(string_split(surface, ' ')) AS word FROM r) SELECT 'accept' AS list, word AS a, '' AS b FROM a WHERE word <> '' UNION ALL SELECT 'swap', lower(surface), surface FROM r WHERE NOT contains(surface, ' ') AND enforce AND NOT collides AND lower(surface) <> surface UNION ALL SELECT 'typos', 'teh', 'the'")
def term_lists(spark: SparkSession, d: str) -> DataFrame:
    found = release.term_artifacts(_terms(spark, d), {"teh": "the"})
    accept = found["accept"].select(F.lit("accept").alias("list"), F.col("word").alias("a"), F.lit("").alias("b"))
    return accept.unionByName(found["swap"].select(F.lit("swap").alias("list"), F.col("wrong").alias("a"), F.col("right").alias("b"))).unionByName(found["typos"].select(F.lit("typos").alias("list"), F.col("wrong").alias("a"), F.col("right").alias("b")))


@query("SELECT p_partkey AS k, p_size % 2 AS even FROM part")
def inventory_json(spark: SparkSession, d: str) -> DataFrame:
    """An inventory written as lines of JSON, flags as numbers, and read again."""
    path = scratch(spark, "inventory")
    release.json_lines(table(spark, d, "part").select(F.col("p_partkey").alias("k"), (F.col("p_size") % 2 == 1).alias("even"))).write.text(path)
    return spark.read.schema("k long, even int").json(path)


@query("SELECT n_regionkey || '.csv' AS name, i AS pos, cells FROM (SELECT n_regionkey, 0 AS i, 'key|name, or \"none\"' AS cells FROM nation GROUP BY n_regionkey UNION ALL SELECT n_regionkey, row_number() OVER (PARTITION BY n_regionkey ORDER BY n_nationkey), n_nationkey || '|' || n_name || ', or \"none\"' FROM nation)")
def csv_sidecars(spark: SparkSession, d: str) -> DataFrame:
    """CSV texts in files of their own, read back as rows of cells."""
    line = F.concat(F.col("n_nationkey").cast("string"), F.lit(',"'), "n_name", F.lit(', or ""none"""'))
    files = table(spark, d, "nation").groupBy("n_regionkey").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("n_nationkey", line.alias("l")))), lambda e: e["l"]), "\n").alias("text"))
    path = scratch(spark, "sidecars")
    text = F.concat(F.lit('key,"name, or ""none"""\n'), "text")
    files.select(text.alias("value"), F.concat(F.col("n_regionkey").cast("string"), F.lit(".csv")).alias("name")).repartition(5, "name").write.partitionBy("name").text(path)
    found = registries.csv_rows(spark, f"{path}/*/*.txt")
    return found.select(F.regexp_extract("path", "name=([^/]+)", 1).alias("name"), "pos", F.array_join("cells", "|").alias("cells"))


# Titles and prefixes


@query("SELECT p_partkey, CASE WHEN p_size % 2 = 0 THEN 'AB' END AS package, CASE WHEN p_size % 2 = 0 THEN '5.3' END AS version, CASE WHEN p_size % 2 = 0 THEN p_partkey::INT END AS number, p_size % 4 = 0 AS several, p_name AS bare FROM part")
def patch_identities(spark: SparkSession, d: str) -> DataFrame:
    patch = F.when(F.col("p_size") % 4 == 0, F.concat(F.lit("AB*5.3*"), "p_partkey", F.lit("/CD*1.0*7 "))).when(F.col("p_size") % 2 == 0, F.concat(F.lit("AB*5.3*"), "p_partkey", F.lit(" - "))).otherwise("Version 2.1, ")
    title = F.concat(patch, "p_name", F.lit(" Rev. 3"))
    return table(spark, d, "part").select("p_partkey", T.patch_identity(title).alias("i"), T.without_versions(title).alias("bare")).select("p_partkey", "i.*", "bare")


@query("SELECT p_partkey, CASE WHEN p_size % 3 = 0 THEN 'B — ' || p_name WHEN p_size % 3 = 1 THEN 'A' ELSE 'alphabet ' || p_name END AS shown FROM part")
def display_titles(spark: SparkSession, d: str) -> DataFrame:
    names = spark.createDataFrame([("x", "A", "Alpha"), ("x", "B", "alpha Beta"), ("y", "C", "alphabet")], "app string, abbr string, alias string")
    title = F.when(F.col("p_size") % 3 == 0, F.concat(F.lit("Alpha beta: "), "p_name", F.lit(" v1.2"))).when(F.col("p_size") % 3 == 1, "ALPHA").otherwise(F.concat(F.lit("alphabet "), "p_name"))
    return catalog.display_titles(table(spark, d, "part").select("p_partkey", title.alias("title"), F.lit("x").alias("app")), "title", "app", names).select("p_partkey", "shown")


_TWO = "split_part(p_name, ' ', 1) || ' ' || split_part(p_name, ' ', 2)"


@query(f"""WITH v AS (SELECT {_TWO} AS member FROM part WHERE p_brand = 'Brand#11' UNION SELECT split_part(p_name, ' ', 1) FROM part WHERE p_brand = 'Brand#12'),
    p AS (SELECT p_partkey, {_TWO} AS two, split_part(p_name, ' ', 1) AS one FROM part)
    SELECT p_partkey, CASE WHEN two IN (SELECT member FROM v) THEN two ELSE one END AS member FROM p WHERE two IN (SELECT member FROM v) OR one IN (SELECT member FROM v)""")
def known_prefixes(spark: SparkSession, d: str) -> DataFrame:
    part = table(spark, d, "part")
    words = F.split("p_name", " ")
    vocabulary = part.where("p_brand = 'Brand#11'").select(F.concat_ws(" ", words[0], words[1]).alias("member")).unionByName(part.where("p_brand = 'Brand#12'").select(words[0].alias("member")))
    return catalog.longest_known_prefix(part, "p_partkey", "p_name", vocabulary)


@query("SELECT p_partkey, replace(replace(p_name, 'e', 'E'), 'Ea', 'x') AS text, concat_ws(',', CASE WHEN contains(p_name, 'e') THEN 'e' END, CASE WHEN contains(replace(p_name, 'e', 'E'), 'Ea') THEN 'Ea' END) AS aliases FROM part")
def corrected_titles(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "part").select("p_partkey", T.corrected(F.col("p_name"), [("e", "E"), ("Ea", "x")]).alias("c")).select("p_partkey", "c.text", F.array_join("c.aliases", ",").alias("aliases"))


@query("""SELECT p_partkey, 2::BIGINT AS images, CASE WHEN p_size % 2 = 0 THEN 1 ELSE 0 END::BIGINT AS found, CASE WHEN p_size % 2 = 0 THEN p_size * 10 ELSE 0 END::BIGINT AS bytes FROM part""")
def asset_statistics(spark: SparkSession, d: str) -> DataFrame:
    part = table(spark, d, "part")
    body = F.concat(F.lit("![a](media/"), "p_size", F.lit(".png) ![b](x/"), "p_size", F.lit(".png) ![c](none.gif)"))
    assets = part.where("p_size % 2 = 0").select(F.concat("p_size", F.lit(".png")).alias("name"), (F.col("p_size") * 10).cast("long").alias("length")).distinct()
    return catalog.asset_stats(part.select("p_partkey", body.alias("body")), "p_partkey", "body", assets)


@query("SELECT l_orderkey, CASE WHEN count(*) + 1 >= 6 OR l_orderkey % 5 = 0 THEN 'reference' ELSE 'narrative' END AS kind FROM lineitem GROUP BY l_orderkey")
def table_kinds(spark: SparkSession, d: str) -> DataFrame:
    head = F.when(F.col("l_orderkey") % 5 == 0, F.array(F.lit("x"), F.lit("Field Name"))).otherwise(F.array(F.lit("x"), F.lit("y")))
    rows = _order_tables(spark, d).select("l_orderkey", F.concat(F.array(head), F.slice("rows", F.lit(2), F.size("rows"))).alias("rows"))
    return rows.select("l_orderkey", catalog.table_kind(F.col("rows"), ["field", "code"], 6).alias("kind"))


@query("""SELECT 'dangling' AS kind, count(*) AS findings, count(*) > 0 AS blocks FROM labels WHERE doc_id NOT IN (SELECT page_id FROM pages) UNION ALL SELECT 'empty', count(*), false FROM documents WHERE text = '' UNION ALL SELECT 'orphans', count(*), count(*) > 0 FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders)""")
def validation_report(spark: SparkSession, d: str) -> DataFrame:
    docs, labels, pages = (table(spark, d, t) for t in ("documents", "labels", "pages"))
    found = {"dangling": labels.join(pages.select(F.col("page_id").alias("doc_id")), "doc_id", "left_anti"), "empty": docs.where("text = ''"), "orphans": checks.orphans(table(spark, d, "lineitem"), "l_orderkey", table(spark, d, "orders"), "o_orderkey")}
    return catalog.validation(found, ["dangling", "orphans"])


@query()
def normalize_documents(spark: SparkSession, d: str) -> DataFrame:
    """Bodies through all steps: what was taken out of each, and a digest of what is left."""
    import hashlib

    def each(b: str) -> list[tuple]:
        got = bodies.normalized(b)
        return [(hashlib.md5(got["body"].encode()).hexdigest(), len(got["revisions"]), len(got["tables"]), sum(v == bodies.UNRESOLVED for v in got["links"].values()))]

    return _rows_of(_built_bodies(spark, d), each, "l_orderkey long, digest string, revisions int, tables int, unresolved int")


# Studies of a vocabulary


@query("""WITH p AS (SELECT p_partkey, CASE p_size % 3 WHEN 0 THEN 'file' WHEN 1 THEN 'routine' ELSE 'build' END AS type, CASE p_size % 3 WHEN 0 THEN (100 + p_partkey % 60)::VARCHAR WHEN 1 THEN split_part(p_name, ' ', 1) ELSE p_type END AS surface FROM part),
    v AS (SELECT DISTINCT upper(split_part(p_name, ' ', 1)) AS word FROM part WHERE p_partkey % 7 = 0),
    r AS (SELECT p.*, n_name, CASE type WHEN 'build' THEN 'unchecked' WHEN 'file' THEN CASE WHEN n_name IS NULL THEN 'not-a-file' ELSE 'valid' END ELSE CASE WHEN upper(surface) IN (SELECT word FROM v) THEN 'valid' ELSE 'unknown-to-the-measured-model' END END AS recognised
        FROM p LEFT JOIN nation ON type = 'file' AND surface = (100 + n_nationkey)::VARCHAR)
    SELECT p_partkey, type, surface, recognised, CASE WHEN type <> 'file' THEN 'inert-no-landing-place' WHEN recognised <> 'valid' THEN 'inert-not-a-real-file' WHEN contains(n_name, ' ') THEN 'would-expand' ELSE 'inert-guards-drop-it' END AS reach, coalesce(n_name, '') AS canonical_name FROM r""")
def candidate_quality(spark: SparkSession, d: str) -> DataFrame:
    k, word = F.col("p_size") % 3, F.split("p_name", " ")[0]
    surface = F.when(k == 0, (F.col("p_partkey") % 60 + 100).cast("string")).when(k == 1, word).otherwise(F.col("p_type"))
    part = table(spark, d, "part")
    proposals = part.select("p_partkey", F.when(k == 0, "file").when(k == 1, "routine").otherwise("build").alias("type"), surface.alias("surface"))
    files = table(spark, d, "nation").select(F.lit("file").alias("type"), (F.col("n_nationkey") + 100).cast("string").alias("surface"), F.col("n_name").alias("name"))
    routines = part.where("p_partkey % 7 = 0").select(F.lit("routine").alias("type"), word.alias("surface"), F.lit("").alias("name"))
    return vocabulary.candidate_quality(proposals, files.unionByName(routines), "file", ["file"])


_FORMS = """WITH m AS (SELECT DISTINCT l_partkey % 50 AS number, l_orderkey AS doc, CASE l_linenumber % 3 WHEN 0 THEN 'number' WHEN 1 THEN 'name' ELSE 'global' END AS form, l_quantity > 25 AS c FROM lineitem WHERE l_partkey % 50 > 2 AND (l_partkey % 5 <> 1 OR l_linenumber % 3 <> 0)),
    o AS (SELECT number, doc, bool_or(form = 'number') AS n, bool_or(form = 'name') AS w, bool_or(form = 'global') AS g, bool_or(form = 'name' AND c) AS k FROM m GROUP BY number, doc),
    f AS (SELECT number, 'file ' || number AS name, count(*) FILTER (n) AS number_docs, count(*) FILTER (w) AS name_docs, count(*) FILTER (g) AS global_docs, count(*) FILTER (k) AS context_docs, count(*) FILTER (w AND NOT n) AS name_only_docs, count(*) FILTER (n AND NOT w) AS number_only_docs,
        count(*) FILTER (k AND NOT n) AS context_only_docs, bool_or(n)::INT + bool_or(w)::INT + bool_or(g)::INT AS forms FROM o GROUP BY number)"""


def _forms(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("l_linenumber") % 3
    said = table(spark, d, "lineitem").where("l_partkey % 50 > 2 AND (l_partkey % 5 <> 1 OR l_linenumber % 3 <> 0)")
    mentions = said.select((F.col("l_partkey") % 50).alias("number"), F.col("l_orderkey").alias("doc"), F.when(k == 0, "number").when(k == 1, "name").otherwise("global").alias("form"), (F.col("l_quantity") > 25).alias("in_context"))
    files = spark.range(60).select(F.col("id").alias("number"), F.concat(F.lit("file "), F.col("id").cast("string")).alias("name"))
    return vocabulary.mention_forms(files, mentions)


@query(f"{_FORMS} SELECT * FROM f")
def mention_forms(spark: SparkSession, d: str) -> DataFrame:
    return _forms(spark, d)


@query(f"""{_FORMS} SELECT count(*) AS mentioned, count(*) FILTER (forms >= 2) AS several_forms, count(*) FILTER (name_only_docs > 0 AND number_docs > 0) AS split_raw, count(*) FILTER (context_only_docs > 0 AND number_docs > 0) AS split_anchored,
    count(*) FILTER (number_docs > 0 AND name_docs = 0) AS number_only, count(*) FILTER (name_docs > 0 AND number_docs = 0) AS name_only,
    coalesce(sum(name_only_docs) FILTER (number_docs > 0), 0)::BIGINT AS pairs_raw, coalesce(sum(context_only_docs) FILTER (number_docs > 0), 0)::BIGINT AS pairs_anchored FROM f""")
def form_totals(spark: SparkSession, d: str) -> DataFrame:
    return vocabulary.form_totals(_forms(spark, d))


@query("""WITH e AS (SELECT s_nationkey, max(s_suppkey) AS line, arg_max(s_name, s_suppkey) AS purpose FROM supplier WHERE s_suppkey % 3 = 0 GROUP BY s_nationkey),
    x AS (SELECT c_custkey, c_name, c_nationkey, c_custkey % 4 <> 3 AS s, i.line AS a, i.purpose AS ap, e.line AS b, e.purpose AS bp, r_name FROM customer LEFT JOIN (SELECT s_suppkey AS line, s_name AS purpose FROM supplier WHERE s_suppkey % 3 = 0) i ON c_custkey = i.line
        LEFT JOIN e ON c_custkey % 2 = 0 AND c_nationkey = s_nationkey LEFT JOIN region ON c_custkey % 50 = r_regionkey)
    SELECT 'c' || c_custkey AS abbr, CASE WHEN NOT s THEN 'excluded' WHEN coalesce(a, b) IS NOT NULL THEN 'profile' WHEN r_name IS NOT NULL THEN 'fallback' ELSE 'needs-fallback' END AS kind,
    CASE WHEN NOT s THEN NULL WHEN coalesce(a, b) IS NOT NULL THEN 'registry' WHEN r_name IS NOT NULL THEN 'manual' END AS source, CASE WHEN NOT s THEN NULL WHEN a IS NOT NULL THEN 'appid' WHEN b IS NOT NULL THEN 'namespace' END AS match,
    CASE WHEN NOT s THEN NULL WHEN a IS NOT NULL THEN 'high' WHEN b IS NOT NULL THEN 'medium' WHEN r_name IS NOT NULL THEN 'low' END AS confidence, CASE WHEN s THEN coalesce(a, b) END AS line, CASE WHEN s THEN coalesce(ap, bp, r_name) END AS purpose,
    CASE WHEN NOT s THEN c_name || ' — inactive' WHEN coalesce(a, b) IS NULL AND r_name IS NULL THEN c_name END AS note FROM x""")
def seeded_profiles(spark: SparkSession, d: str) -> DataFrame:
    key = F.col("c_custkey").cast("string")
    abbr, land = F.concat(F.lit("c"), key), F.concat(F.lit("n"), F.col("c_nationkey").cast("string"))
    apps = table(spark, d, "customer").select(abbr.alias("abbr"), F.col("c_name").alias("name"), key.alias("appid"), F.when(F.col("c_custkey") % 2 == 0, land).otherwise("").alias("namespace"), (F.col("c_custkey") % 4 != 3).alias("in_scope"), F.lit("inactive").alias("reason"), (F.col("c_custkey") % 50).alias("k"))
    entries = table(spark, d, "supplier").where("s_suppkey % 3 = 0").select(F.col("s_suppkey").cast("string").alias("appid"), F.concat(F.lit("n"), F.col("s_nationkey").cast("string")).alias("namespace"), F.col("s_suppkey").cast("long").alias("line"), F.col("s_name").alias("purpose"))
    fallbacks = apps.join(table(spark, d, "region").select(F.col("r_regionkey").alias("k"), F.col("r_name").alias("purpose")), "k").select("abbr", "purpose")
    return vocabulary.seed_profiles(apps.drop("k"), entries, fallbacks)


@query("""SELECT o_orderkey AS l_orderkey, 'Order' || chr(10) || chr(10) || CASE WHEN o_orderkey % 2 = 0 THEN '```console' ELSE '```mumps' END || chr(10) || CASE WHEN o_orderkey % 2 = 0 THEN '>' ELSE '' END || 'S X=' || o_orderkey || chr(10) || 'W $P(X,1)' || chr(10) || '```' || chr(10) || chr(10) || 'If the call (x)' AS fenced,
    1::BIGINT AS blocks, (1 - o_orderkey % 2)::BIGINT AS consoles, (2 - o_orderkey % 2)::BIGINT AS unescaped FROM orders""")
def code_fences(spark: SparkSession, d: str) -> DataFrame:
    key = F.col("o_orderkey").cast("string")
    prompt = F.when(F.col("o_orderkey") % 2 == 0, "\\>").otherwise("")
    body = F.concat(F.lit("Order\n**"), prompt, F.lit("S X="), key, F.lit("**\n\nW \\$P(X,1)\nIf the call (x)"))
    rows = table(spark, d, "orders").select(F.col("o_orderkey").alias("l_orderkey"), body.alias("body"))

    def each(b):
        new, told = bodies.fence_code(b)
        return [(new, told.blocks, told.consoles, told.unescaped)]

    return _rows_of(rows, each, "l_orderkey long, fenced string, blocks long, consoles long, unescaped long", copies=False)
