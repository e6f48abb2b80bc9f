"""Queries of template mining over the test tables: an order is a document, its lines are the sections."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.operators import templates
from quarry.plans.register import registry
from quarry.session import staged, table

QUERIES, ORACLES, query = registry()


def order_outlines(spark: SparkSession, d: str) -> DataFrame:
    """(doc_id, doc_type, era, outline): titles are the parts' types, in every other order with numbers in front."""
    lines = table(spark, d, "lineitem").join(table(spark, d, "part"), F.col("l_partkey") == F.col("p_partkey"))
    number = F.when(F.col("l_orderkey") % 2 == 0, F.concat(F.col("l_linenumber").cast("string"), F.lit(". "))).otherwise("")
    head = F.struct("l_linenumber", "l_partkey", "l_suppkey", (2 + F.col("p_size") % 3).cast("int").alias("level"), F.concat(number, F.initcap("p_type")).alias("title"))
    rows = lines.groupBy("l_orderkey").agg(F.transform(F.array_sort(F.collect_list(head)), lambda x: F.struct(x["level"].alias("level"), x["title"].alias("title"))).alias("outline"))
    era = F.concat(F.substring(F.date_format("o_orderdate", "yyyy"), 1, 3), F.lit("0s"))
    return table(spark, d, "orders").join(rows, F.col("o_orderkey") == F.col("l_orderkey")).select(F.col("o_orderkey").alias("doc_id"), F.col("o_orderpriority").alias("doc_type"), era.alias("era"), "outline")


_MINED: dict[tuple[str, str], DataFrame] = {}


def _mined(spark: SparkSession, d: str) -> DataFrame:
    return _mined_of(spark, d)[1]


def _mined_of(spark: SparkSession, d: str, keep: bool = False) -> tuple[DataFrame, DataFrame]:
    """The outlines and their templates; outlines that are used again after mining are written once, if there is something to mine."""
    at = (spark.sparkContext.applicationId, d)
    outlines = order_outlines(spark, d)
    if at not in _MINED:
        outlines = staged(outlines, "order-outlines") if keep else outlines
        _MINED[at] = staged(templates.mine(outlines), "templates")
    return outlines, _MINED[at]


@query()
def template_schemas(spark: SparkSession, d: str) -> DataFrame:
    """Templates with their sections as lines: level, title, pattern, flags and documents."""
    flag = lambda c, s: F.when(c, s).otherwise("")
    line = F.transform("sections", lambda s: F.concat_ws("|", s["level"].cast("string"), s["section_id"], s["title"], s["title_pattern"], flag(s["required"], "required"), flag(s["repeatable"], "repeatable"), s["documents"].cast("string")))
    return _mined(spark, d).select("template_id", "doc_type", "era", "cluster", "doc_count", "grade", F.concat_ws(",", F.col("sample_doc_ids").cast("array<string>")).alias("samples"), F.array_join(line, "\n").alias("sections"))


@query()
def template_bodies(spark: SparkSession, d: str) -> DataFrame:
    """Orders as bodies with a cover, sections of which every third is empty, under the templates of their type and era."""
    body = F.transform("outline", lambda s, i: F.concat(F.repeat(F.lit("#"), s["level"]), F.lit(" "), s["title"], F.when(i % 3 == 1, F.lit("\n")).otherwise(F.concat(F.lit("\n\ntext of "), s["title"]))))
    cover = F.concat(F.lit("**Order "), F.col("doc_id").cast("string"), F.lit("**\n\n![logo](x.png)\n\n"), F.when(F.col("doc_id") % 4 > 0, "March 1999\n\n").otherwise(""))
    outlines, mined = _mined_of(spark, d, keep=True)
    docs = outlines.select("doc_id", "doc_type", "era", F.concat(cover, F.array_join(body, "\n\n")).alias("body"), F.concat(F.lit("Order "), "doc_id").alias("title"), F.lit("1.0").alias("version"), F.lit(None).cast("string").alias("patch"), F.lit("").alias("url"))
    return templates.applied(docs, mined).select("doc_id", "template_id", "published", F.md5("body").alias("body"))
