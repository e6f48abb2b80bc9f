"""Inventory selection, admission and completeness."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def selection(everything: bool = False, **dimensions: list[str] | None) -> Column:
    """AND over the dimensions, OR within each; nothing given matches nothing."""
    if everything:
        return F.lit(True)
    given = {c: v for c, v in dimensions.items() if v}
    if not given:
        return F.lit(False)
    out = F.lit(True)
    for c, v in given.items():
        out = out & F.col(c).isin(v)
    return out


def admitted(prefixes: list[str], system: str, denied: list[str], status: str, omitted: list[str], kind: str) -> Column:
    """In scope by prefix and status, and not of an omitted type."""
    scope = F.lit(False)
    for p in prefixes:
        scope = scope | F.col(system).startswith(p)
    return scope & ~F.col(status).isin(denied) & ~F.col(kind).isin(omitted)


def with_whole_groups(rows: DataFrame, chosen: Column, group: str, key: str) -> DataFrame:
    """All rows of the groups in which any row was chosen, the first of each key."""
    groups = rows.where(chosen).select(group).distinct()
    return rows.join(groups, group, "left_semi").dropDuplicates([key])


def sole_survivors(rows: DataFrame, retired: Column, group: str) -> DataFrame:
    """Groups of retired rows without any row that is not retired."""
    return rows.where(retired).select(group).distinct().join(rows.where(~retired).select(group), group, "left_anti")


def inherit_from_peers(rows: DataFrame, group: str, value: str) -> DataFrame:
    """rows with inherited: the value, or, where it is empty, the only distinct value of its group."""
    by = Window.partitionBy(group)
    filled = F.nullif(F.col(value), F.lit(""))
    least, most = F.min(filled).over(by), F.max(filled).over(by)
    return rows.withColumn("inherited", F.coalesce(filled, F.when(least == most, least)))


def disposition(rules: list[tuple[Column, str]], otherwise: str) -> Column:
    """The first rule that holds names the row."""
    out = F.lit(otherwise)
    for test, name in reversed(rules):
        out = F.when(test, name).otherwise(out)
    return out


def facet_distribution(rows: DataFrame, facets: list[str]) -> DataFrame:
    """(facet, value, n) of all non-empty values: one pass, one aggregation."""
    pairs = F.array(*[F.struct(F.lit(c).alias("facet"), F.col(c).cast("string").alias("value")) for c in facets])
    each = rows.select(F.explode(pairs).alias("x")).where("x.value IS NOT NULL AND x.value <> ''")
    return each.groupBy("x.facet", "x.value").agg(F.count("*").alias("n"))


def coverage(rows: DataFrame, fields: list[str], floor: Mapping[str, float]) -> DataFrame:
    """(field, populated, total, pct, health): PASS where the share reaches the field's floor, else FAIL."""
    aggs = []
    for c in fields:
        aggs.append(F.count_if(F.coalesce(F.col(c).cast("string"), F.lit("")) != "").alias(c))
    one = rows.agg(F.count("*").alias("total"), *aggs)
    each = one.select("total", F.explode(F.array(*[F.struct(F.lit(c).alias("field"), F.col(c).alias("populated"), F.lit(float(floor.get(c, 0.0))).alias("floor")) for c in fields])).alias("x"))
    pct = F.when(F.col("total") > 0, F.col("x.populated") / F.col("total") * 100).otherwise(100.0)
    return each.select("x.field", "x.populated", "total", F.round(pct, 4).alias("pct"), F.when(pct >= F.col("x.floor"), "PASS").otherwise("FAIL").alias("health"))


def crawl_floor(prior: DataFrame, now: DataFrame, section: str, ratio: float) -> DataFrame:
    """(section, before, after, verdict): dark where nothing came, low below the ratio, else ok."""
    b, a = prior.groupBy(section).agg(F.count("*").alias("before")), now.groupBy(section).agg(F.count("*").alias("after"))
    both = b.join(a, section, "left").withColumn("after", F.coalesce("after", F.lit(0)))
    return both.withColumn("verdict", F.when(F.col("after") == 0, "dark").when(F.col("after") < ratio * F.col("before"), "low").otherwise("ok"))
