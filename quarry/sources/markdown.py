"""Markdown bodies: conversations as documents with headings, and the shredding of bodies into sections."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Fewer tokens make a section a stub or hollow.
MIN_TOKENS = 8


def conversation_bodies(conversations: DataFrame) -> DataFrame:
    """One markdown body for each conversation: a title, then a heading for each turn and its text."""
    turn = F.concat(F.lit("## "), "role", F.lit("\n"), F.coalesce("text", F.lit("")))
    rows = conversations.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", turn.alias("part")))).alias("parts"))
    return rows.select(F.col("conv_id").alias("doc_key"), F.concat(F.lit("# Conversation "), F.col("conv_id").cast("string"), F.lit("\n"), F.array_join(F.transform("parts", lambda p: p["part"]), "\n")).alias("body"))


def lines(bodies: DataFrame) -> DataFrame:
    """(doc_key, pos, line, fenced): lines in order, with whether a code fence is open before the line."""
    each = bodies.select("doc_key", F.posexplode(F.split("body", "\n", -1)).alias("pos", "line"))
    order = Window.partitionBy("doc_key").orderBy("pos").rowsBetween(Window.unboundedPreceding, -1)
    fence = F.col("line").rlike("^ {0,3}(```|~~~)")
    return each.withColumn("fenced", F.coalesce(F.sum(fence.cast("int")).over(order) % 2 == 1, F.lit(False)))


def section_kind(is_container: Column, has_referent: Column, tokens: Column) -> Column:
    return F.when(is_container, "container").when(tokens >= MIN_TOKENS, "ok").when(has_referent, "stub").otherwise("hollow")


def sections(bodies: DataFrame) -> DataFrame:
    """Sections of bodies(doc_key, body): seq, level, title, path, slug, tokens, kind, searchable.

    A heading's text runs to the next heading. The path holds the title of the last heading of each smaller
    level that no heading of that level or above has closed since. The nth repeat of a slug gets -n. A
    document is one window partition; its headings are far fewer than its lines.
    """
    marked = lines(bodies).withColumn("level", F.when(~F.col("fenced"), F.length(F.regexp_extract("line", r"^(#{1,6}) +\S", 1))).otherwise(0))
    order = Window.partitionBy("doc_key").orderBy("pos")
    marked = marked.withColumn("seq", F.sum((F.col("level") > 0).cast("long")).over(order)).where("seq > 0")
    token_count = F.when(F.col("level") > 0, 0).otherwise(F.regexp_count("line", F.lit(r"[^ \t]+"))).cast("long")
    referent = F.col("line").rlike(r"\]\(tables/|!\[")
    grouped = marked.groupBy("doc_key", "seq").agg(
        F.max("level").alias("level"),
        F.max(F.when(F.col("level") > 0, F.trim(F.regexp_replace("line", r"^#+ +", "")))).alias("title"),
        F.sum(token_count).alias("tokens"),
        F.coalesce(F.bool_or(referent), F.lit(False)).alias("has_referent"),
    )
    by = Window.partitionBy("doc_key").orderBy("seq")
    before = by.rowsBetween(Window.unboundedPreceding, -1)
    out = grouped.withColumn("next_level", F.lead("level").over(by))
    for m in range(1, 6):
        # The last heading of level m, unless one of a smaller level came after it.
        out = out.withColumn(f"_at{m}", F.max(F.when(F.col("level") == m, F.col("seq"))).over(before))
        out = out.withColumn(f"_t{m}", F.last(F.when(F.col("level") == m, F.col("title")), True).over(before))
        out = out.withColumn(f"_up{m}", F.max(F.when(F.col("level") < m, F.col("seq"))).over(before))
    parts = [F.when((F.col("level") > m) & F.col(f"_at{m}").isNotNull() & (F.col(f"_at{m}") > F.coalesce(f"_up{m}", F.lit(0))), F.col(f"_t{m}")) for m in range(1, 6)]
    base = F.regexp_replace(F.regexp_replace(F.lower("title"), r"[^\p{L}\p{N}_\- ]", ""), " ", "-")
    out = out.withColumn("path", F.concat_ws(" > ", *parts)).withColumn("_base", base)
    nth = F.row_number().over(Window.partitionBy("doc_key", "_base").orderBy("seq")) - 1
    out = out.withColumn("slug", F.when(nth > 0, F.concat("_base", F.lit("-"), nth.cast("string"))).otherwise(F.col("_base")))
    container = F.coalesce(F.col("next_level") > F.col("level"), F.lit(False))
    kind = section_kind(container & (F.col("tokens") == 0), F.col("has_referent"), F.col("tokens"))
    return out.select("doc_key", "seq", "level", "title", "path", "slug", "tokens", kind.alias("kind"), ((F.col("tokens") > 0) | F.col("has_referent")).alias("searchable"))


def table_of_contents(found: DataFrame, first: int = 2, last: int = 3) -> DataFrame:
    """Entries of the levels first..last as links, in order, one text for each document."""
    entry = F.concat(F.repeat(F.lit("  "), F.col("level") - F.lit(first)), F.lit("- ["), "title", F.lit("](#"), "slug", F.lit(")"))
    rows = found.where(F.col("level").between(first, last))
    return rows.groupBy("doc_key").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("seq", entry.alias("entry")))), lambda e: e["entry"]), "\n").alias("toc"))
