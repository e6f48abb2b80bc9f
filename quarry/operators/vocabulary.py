"""Studies of a vocabulary: what proposals are worth, under which forms a file is mentioned, profiles from registries."""

from __future__ import annotations

from collections.abc import Collection

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Fixed value: characters other than letters and digits between a name and the word that marks it as a file's.
CONTEXT = 24


def candidate_quality(proposals: DataFrame, vocabulary: DataFrame, exact: str, landing: Collection[str]) -> DataFrame:
    """proposals(type, surface, ...), vocabulary(type, surface, name) -> proposals with recognised, reach and canonical_name.

    Surfaces of the type `exact` (numbers of files) are compared as they are, others in capitals. Only types in `landing`
    can reach a search, and of these only surfaces whose name makes a usable expansion. A null type has no vocabulary."""
    key = F.when(F.col("type") == exact, F.col("surface")).otherwise(F.upper("surface"))
    known = vocabulary.groupBy("type", key.alias("_key")).agg(F.coalesce(F.max("name"), F.lit("")).alias("_name"))
    types = vocabulary.groupBy("type").agg(F.lit(True).alias("_measured"))
    looked = proposals.withColumn("_key", key).join(known, ["type", "_key"], "left").join(types, "type", "left")
    valid, number = F.col("_name").isNotNull(), F.coalesce(F.col("type") == exact, F.lit(False))
    recognised = F.when(F.col("_measured").isNull(), "unchecked").when(valid, "valid").otherwise(F.when(number, "not-a-file").otherwise("unknown-to-the-measured-model"))
    usable = F.upper("surface").rlike("^[A-Z0-9]{3,}$") & (F.size(F.split(F.trim("_name"), r"\s+")) >= 2)
    lands = F.coalesce(F.col("type").isin(*landing), F.lit(False))
    reach = F.when(~lands, "inert-no-landing-place").when(~valid, "inert-not-a-real-file").when(usable, "would-expand").otherwise("inert-guards-drop-it")
    name = F.when(number, F.coalesce("_name", F.lit(""))).otherwise("")
    return looked.select(*proposals.columns, recognised.alias("recognised"), reach.alias("reach"), name.alias("canonical_name"))


def in_file_context(text: Column, name: Column, number: Column) -> Column:
    """Whether the name stands in the text near the word "file", or before its number as in "name (#12"."""
    whole, between = F.concat(F.lit("\\Q"), name, F.lit("\\E")), F.lit(f"\\W{{0,{CONTEXT}}}")
    pattern = F.concat(F.lit("(?i)file\\w*"), between, whole, F.lit("|"), whole, between, F.lit("file|"), whole, F.lit("\\s*\\(?\\s*#\\s*\\Q"), number, F.lit("\\E"))
    return F.regexp_like(text, pattern)


def mention_forms(files: DataFrame, mentions: DataFrame) -> DataFrame:
    """files(number, name), mentions(number, doc, form, in_context) -> how many documents mention a file by which form.

    form is 'number', 'name' or 'global'; files that nothing mentions are left out. One aggregation by file and document,
    one by file: no set of documents is gathered."""
    has = lambda form: F.coalesce(F.max(F.col("form") == form), F.lit(False))
    once = mentions.groupBy("number", "doc").agg(has("number").alias("n"), has("name").alias("w"), has("global").alias("g"), F.coalesce(F.max((F.col("form") == "name") & F.col("in_context")), F.lit(False)).alias("c"))
    told = once.groupBy("number").agg(
        F.count_if("n").alias("number_docs"), F.count_if("w").alias("name_docs"), F.count_if("g").alias("global_docs"), F.count_if("c").alias("context_docs"),
        F.count_if(F.expr("w AND NOT n")).alias("name_only_docs"), F.count_if(F.expr("n AND NOT w")).alias("number_only_docs"), F.count_if(F.expr("c AND NOT n")).alias("context_only_docs"),
    )
    forms = sum(((F.col(c) > 0).cast("int") for c in ("name_docs", "global_docs")), (F.col("number_docs") > 0).cast("int"))
    return files.join(told, "number").withColumn("forms", forms).where("forms > 0")


def form_totals(forms: DataFrame) -> DataFrame:
    """mention_forms() -> one row: files by how they are mentioned, and documents that a search by number misses."""
    raw, anchored = "name_only_docs > 0 AND number_docs > 0", "context_only_docs > 0 AND number_docs > 0"
    return forms.agg(
        F.count("*").alias("mentioned"), F.count_if(F.expr("forms >= 2")).alias("several_forms"), F.count_if(F.expr(raw)).alias("split_raw"), F.count_if(F.expr(anchored)).alias("split_anchored"),
        F.count_if(F.expr("number_docs > 0 AND name_docs = 0")).alias("number_only"), F.count_if(F.expr("name_docs > 0 AND number_docs = 0")).alias("name_only"),
        F.coalesce(F.sum(F.when(F.expr(raw), F.col("name_only_docs"))), F.lit(0)).alias("pairs_raw"), F.coalesce(F.sum(F.when(F.expr(anchored), F.col("context_only_docs"))), F.lit(0)).alias("pairs_anchored"),
    )


def seed_profiles(apps: DataFrame, entries: DataFrame, fallbacks: DataFrame) -> DataFrame:
    """apps(abbr, name, appid, namespace, in_scope, reason), entries(appid, namespace, line, purpose), fallbacks(abbr, purpose)
    -> (abbr, kind, source, match, confidence, line, purpose, note), one row for each app.

    An entry is found by the app's id, else by its namespace (of several the last line), else a curated fallback is taken."""

    def by(column: str, mark: str) -> DataFrame:
        return entries.where(f"{column} <> ''").groupBy(column).agg(F.max_by(F.struct("line", "purpose"), "line").alias(mark))

    more = fallbacks.groupBy("abbr").agg(F.struct(F.lit(None).cast("long").alias("line"), F.max("purpose").alias("purpose")).alias("_more"))
    all_of = apps.join(by("appid", "_id"), "appid", "left").join(by("namespace", "_space"), "namespace", "left").join(more, "abbr", "left")
    out = ~F.coalesce("in_scope", F.lit(False))
    kind = F.when(out, "excluded").when(F.coalesce("_id", "_space").isNotNull(), "profile").when(F.col("_more").isNotNull(), "fallback").otherwise("needs-fallback")
    found = F.when(~out, F.coalesce("_id", "_space", "_more"))
    match = F.when(F.col("kind") == "profile", F.when(F.col("_id").isNotNull(), "appid").otherwise("namespace"))
    told = all_of.withColumn("kind", kind).withColumn("_found", found).withColumn("match", match)
    source = F.when(F.col("kind") == "profile", "registry").when(F.col("kind") == "fallback", "manual")
    confidence = F.when(F.col("match") == "appid", "high").when(F.col("match") == "namespace", "medium").when(F.col("kind") == "fallback", "low")
    note = F.when(F.col("kind") == "excluded", F.concat_ws(" — ", "name", "reason")).when(F.col("kind") == "needs-fallback", F.col("name"))
    return told.select("abbr", "kind", source.alias("source"), "match", confidence.alias("confidence"), "_found.line", "_found.purpose", note.alias("note"))
