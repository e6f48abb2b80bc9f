"""Queries of the scalar text functions over the test tables, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.functions import text as T
from quarry.session import table


def block_keys(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", T.block_key(F.col("text")).alias("key"), T.word_count("text").alias("words"))


def slugs(spark: SparkSession, d: str) -> DataFrame:
    said = F.concat(F.lit("  "), "text", F.lit("\n"))
    return table(spark, d, "documents").select("doc_id", F.md5(T.slugify(said)).alias("slug"), T.safe_component(F.col("text")).alias("component"))


def scrubbed(spark: SparkSession, d: str) -> DataFrame:
    dirty = F.concat(F.lit("\u0001"), "text", F.lit("\u007f"))
    return table(spark, d, "documents").select("doc_id", F.length(T.scrub_control(dirty)).cast("long").alias("n"), F.md5(T.scrub_control(dirty)).alias("digest"))


def stripped_pages(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "pages").select("page_id", F.md5(T.strip_html(F.col("html"))).alias("digest"), F.length(T.strip_html(F.col("html"))).cast("long").alias("n"))


def url_parts(spark: SparkSession, d: str) -> DataFrame:
    u = F.col("url")
    return table(spark, d, "pages").select("page_id", T.url_host(u).alias("host"), T.url_extension(F.concat(F.regexp_replace(u, "[?#].*$", ""), F.lit("/Guide_V2.DOCX?x=1"))).alias("ext"), T.doc_slug(F.concat(u, F.lit("/My Guide-v2.docx"))).alias("slug"), T.safe_component(u).alias("safe"))


def dates(spark: SparkSession, d: str) -> DataFrame:
    short = F.when(F.col("o_orderkey") % 5 == 0, F.date_format("o_orderdate", "MMM,  yyyy")).when(F.col("o_orderkey") % 5 == 1, F.date_format("o_orderdate", "MMM. yyyy"))
    said = F.when(F.col("o_orderkey") % 7 == 0, F.lit("no date")).otherwise(F.concat(F.lit("Revised "), F.coalesce(short, F.date_format("o_orderdate", "MMMM yyyy")), F.lit(" for use")))
    return table(spark, d, "orders").select("o_orderkey", T.month_year(said).alias("iso"), T.decade(said).alias("decade"))


def headings(spark: SparkSession, d: str) -> DataFrame:
    line = F.concat(F.lit("## **"), "p_name", F.lit(":** "))
    numbered = F.concat(F.col("p_size").cast("string"), F.lit(".2. "), "p_name")
    return table(spark, d, "part").select("p_partkey", T.heading_text(line).alias("heading"), T.strip_numbering(numbered).alias("title"), T.md_link_text(F.concat(F.lit("see ["), "p_name", F.lit("](#x) now"))).alias("linked"))


def versions(spark: SparkSession, d: str) -> DataFrame:
    text = F.when(F.col("p_size") % 3 == 0, F.lit("none")).otherwise(F.concat("p_size", F.lit("."), F.col("p_partkey").cast("string")))
    patch = F.concat(F.lit("AB*"), "p_size", F.lit("*"), F.when(F.col("p_size") % 5 == 0, F.lit("x")).otherwise(F.col("p_partkey").cast("string")))
    return table(spark, d, "part").select("p_partkey", T.version_parts(text)["major"].alias("major"), T.version_parts(text)["minor"].alias("minor"), T.third_number(patch).alias("patch"))


def surfaces(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "part").select("p_partkey", T.normal_surface(F.concat(F.lit("  "), "p_name", F.lit("  x "))).alias("surface"), T.is_distinctive(F.col("p_type")).alias("distinctive"), T.is_distinctive(F.col("p_brand")).alias("brand_distinctive"), T.first_keyword(F.col("p_type"), [("brass", "metal"), ("steel", "alloy"), ("tin", "soft")]).alias("role"))


def tables_read(spark: SparkSession, d: str) -> DataFrame:
    html = F.concat(F.lit("<table><tr><th>Key</th><th>Name</th></tr><tr><td>"), F.col("n_nationkey").cast("string"), F.lit("</td><td><b>"), "n_name", F.lit("</b> &amp; co</td></tr></table>"))
    line = F.concat(F.lit("| "), "n_name", F.lit(" | a \\| b |"))
    rows = T.html_rows(html)
    return table(spark, d, "nation").select("n_nationkey", F.size(rows).cast("long").alias("n_rows"), F.concat_ws("/", rows[1]).alias("row1"), F.concat_ws("/", T.pipe_cells(line)).alias("cells"))


def acronym_lists(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", F.concat_ws(",", F.array_sort(T.acronyms(F.col("text")))).alias("acronyms"))


QUERIES = {
    "text_block_key": block_keys,
    "text_slugs": slugs,
    "text_scrub_control": scrubbed,
    "text_strip_html": stripped_pages,
    "text_url_parts": url_parts,
    "text_month_decade": dates,
    "text_headings": headings,
    "text_version_parts": versions,
    "text_surfaces": surfaces,
    "text_table_rows": tables_read,
    "text_acronyms": acronym_lists,
}

_UNESCAPED = r"""replace(replace(replace(replace(replace(replace(replace(replace(regexp_replace(html, '<[^>]+>', '', 'g'), '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', ''''), '&nbsp;', ' '), '&copy;', '©'), '&middot;', '·'), '&amp;', '&')"""

ORACLES = {
    "text_block_key": r"SELECT doc_id, trim(regexp_replace(lower(text), '[ \t\n\r\x0B\f]+', ' ', 'g')) AS key, len(regexp_extract_all(text, '[^ \t\n\r\x0B\f]+'))::BIGINT AS words FROM documents",
    "text_slugs": r"""SELECT doc_id, md5(replace(regexp_replace(regexp_replace(lower('  ' || h || chr(10)), '^[ \t\n\r\x0B\f]+|[ \t\n\r\x0B\f]+$', '', 'g'), '[^\p{L}\p{N}_\- ]', '', 'g'), ' ', '-')) AS slug,
        coalesce(nullif(regexp_replace(regexp_replace(h, '[^A-Za-z0-9._-]+', '_', 'g'), '^_+|_+$', '', 'g'), ''), '_') AS component
        FROM (SELECT doc_id, text AS h FROM documents)""",
    "text_scrub_control": r"SELECT doc_id, length(s)::BIGINT AS n, md5(s) AS digest FROM (SELECT doc_id, regexp_replace(chr(1) || text || chr(127), '[\x00-\x08\x0B\x0C\x0E-\x1F\x7F]', '', 'g') AS s FROM documents)",
    "text_strip_html": rf"SELECT page_id, md5(s) AS digest, length(s)::BIGINT AS n FROM (SELECT page_id, trim(regexp_replace({_UNESCAPED}, '[ \t]+', ' ', 'g')) AS s FROM pages)",
    "text_url_parts": r"""SELECT page_id, lower(regexp_extract(url, '^[a-zA-Z]+://([^/?#]+)', 1)) AS host, 'docx' AS ext, 'my_guide_v2' AS slug,
        coalesce(nullif(regexp_replace(regexp_replace(url, '[^A-Za-z0-9._-]+', '_', 'g'), '^_+|_+$', '', 'g'), ''), '_') AS safe FROM pages""",
    "text_month_decade": """WITH s AS (SELECT o_orderkey, o_orderkey % 7 <> 0 AS told, o_orderdate FROM orders)
        SELECT o_orderkey, CASE WHEN told THEN strftime(o_orderdate, '%Y-%m') END AS iso,
        CASE WHEN told THEN substring(strftime(o_orderdate, '%Y'), 1, 3) || '0s' ELSE 'unknown' END AS decade FROM s""",
    "text_headings": "SELECT p_partkey, p_name AS heading, p_name AS title, 'see ' || p_name || ' now' AS linked FROM part",
    "text_version_parts": "SELECT p_partkey, CASE WHEN p_size % 3 = 0 THEN '' ELSE p_size::VARCHAR END AS major, CASE WHEN p_size % 3 = 0 THEN '' ELSE p_partkey::VARCHAR END AS minor, CASE WHEN p_size % 5 <> 0 THEN p_partkey::INT END AS patch FROM part",
    "text_surfaces": r"""SELECT p_partkey, upper(trim(regexp_replace('  ' || p_name || '  x ', '\s+', ' ', 'g'))) AS surface,
        regexp_matches(p_type, '[0-9]') OR starts_with(p_type, '^') OR regexp_matches(p_type, '\S\s+\S') AS distinctive,
        regexp_matches(p_brand, '[0-9]') OR starts_with(p_brand, '^') OR regexp_matches(p_brand, '\S\s+\S') AS brand_distinctive,
        CASE WHEN contains(lower(p_type), 'brass') THEN 'metal' WHEN contains(lower(p_type), 'steel') THEN 'alloy' WHEN contains(lower(p_type), 'tin') THEN 'soft' END AS role FROM part""",
    "text_table_rows": "SELECT n_nationkey, 2::BIGINT AS n_rows, n_nationkey || '/' || n_name || ' & co' AS row1, n_name || '/a | b' AS cells FROM nation",
    "text_acronyms": r"SELECT doc_id, array_to_string(list_sort(list_distinct(list_filter(regexp_extract_all(text, '[\p{L}\p{N}_]+'), lambda w: regexp_full_match(w, '[A-Z][A-Z0-9]{1,7}')))), ',') AS acronyms FROM documents",
}
