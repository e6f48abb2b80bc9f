"""Terms and entities: resolution of mentions to known nodes, synonyms, casing, proposals and glossaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.functions.text import is_distinctive, normal_surface


def resolve_mentions(found: DataFrame, nodes: DataFrame, number_type: str, root_type: str) -> tuple[DataFrame, DataFrame]:
    """found(doc, type, surface), nodes(node, number, surfaces: array) -> resolved (doc, node, surface), unresolved (doc, type, surface, n).

    A mention of number_type is looked up by number, any other by its normalised surface. A mention of root_type that
    only begins a surface resolved in the same document is part of it and not unresolved."""
    numbers = nodes.where("number IS NOT NULL").select(F.col("number").alias("surface"), F.lit(number_type).alias("type"), "node")
    named = nodes.select("node", F.explode("surfaces").alias("s")).where("s <> ''").groupBy(normal_surface(F.col("s")).alias("_key")).agg(F.min("node").alias("_named"))
    looked = found.join(numbers.groupBy("type", "surface").agg(F.min("node").alias("_numbered")), ["type", "surface"], "left").withColumn("_key", normal_surface(F.col("surface"))).join(named, "_key", "left")
    told = looked.select("doc", "type", "surface", F.coalesce("_numbered", "_named").alias("node"), F.col("_named").isNotNull().alias("by_name"))
    resolved = told.where("node IS NOT NULL").select("doc", "node", "surface").distinct()
    open_ones = told.where("node IS NULL").groupBy("doc", "type", "surface").agg(F.count("*").alias("n"))
    # Beginnings of resolved surfaces of the document: every prefix of them, joined by equality.
    roots = told.where("by_name").select("doc", F.upper("surface").alias("_whole")).distinct()
    begun = roots.select("doc", F.explode(F.transform(F.sequence(F.lit(1), F.length("_whole")), lambda i: F.substr(F.col("_whole"), F.lit(1), i))).alias("_part")).distinct()
    parts = open_ones.where(F.col("type") == root_type).join(begun, (open_ones["doc"] == begun["doc"]) & (F.upper(open_ones["surface"]) == begun["_part"]), "left_semi")
    return resolved, open_ones.join(parts.select("doc", "type", "surface"), ["doc", "type", "surface"], "left_anti")


def proposals(unresolved: DataFrame, shown: int = 5) -> DataFrame:
    """unresolved(doc, type, surface, n) -> (type, surface, occurrences, documents, docs: the first few of them).

    Documents are counted and the first kept by ranks within a surface, so that none is gathered whole."""
    once = unresolved.groupBy("type", "surface", "doc").agg(F.sum("n").alias("n"))
    place = F.row_number().over(Window.partitionBy("type", "surface").orderBy("doc"))
    ranked = once.withColumn("_place", place)
    return ranked.groupBy("type", "surface").agg(F.sum("n").alias("occurrences"), F.count("*").alias("documents"), F.sort_array(F.collect_list(F.when(F.col("_place") <= shown, F.col("doc")))).alias("docs"))


def synonym_rows(nodes: DataFrame) -> DataFrame:
    """nodes(node, name, synonyms) -> (node, surface, kind): the name, then each synonym that is not the name, once."""
    name = nodes.where("name <> ''").select("node", F.col("name").alias("surface"), F.lit("canonical_name").alias("kind"))
    more = nodes.select("node", "name", F.explode("synonyms").alias("surface")).where("surface <> '' AND (name IS NULL OR surface <> name)").select("node", "surface").distinct()
    return name.unionByName(more.withColumn("kind", F.lit("synonym")))


def tagging_surfaces(nodes: DataFrame) -> DataFrame:
    """(node, surface) of the surfaces distinct enough to be looked for in prose."""
    return synonym_rows(nodes).where(is_distinctive(F.trim("surface"))).select("node", "surface")


def reconcile_nodes(nodes: DataFrame, entities: DataFrame) -> DataFrame:
    """nodes(node, type, canonical, ...) whose entity the index has, with its entity_id; others are dropped."""
    told = nodes.withColumn("entity_id", F.concat_ws(":", "type", "canonical"))
    return told.join(entities.select("entity_id").distinct(), "entity_id", "left_semi")


def brand_cased(surface: Column) -> Column:
    """Capitals and small letters mixed in a way that no ordinary word is."""
    capitalised = F.concat(F.upper(F.substring(surface, 1, 1)), F.lower(F.substr(surface, F.lit(2))))
    return surface.rlike("[A-Z]") & surface.rlike("[a-z]") & (surface != capitalised)


def with_collisions(terms: DataFrame, surface: str, words: DataFrame) -> DataFrame:
    """terms with collides: the surface in small letters is a word of words(word), and it is not brand-cased."""
    known = terms.join(words.select(F.col("word").alias("_word"), F.lit(True).alias("_known")).distinct(), F.lower(F.col(surface)) == F.col("_word"), "left")
    return known.withColumn("collides", F.coalesce("_known", F.lit(False)) & ~brand_cased(F.col(surface))).drop("_word", "_known")


def classify_terms(products: DataFrame, words: DataFrame) -> DataFrame:
    """products(abbr, full, match: array, enforce, class) -> (surface, class, enforce, collides), a row for each surface.

    One entry that opts out of casing is enough; full names never do. The class is that of the first entry (smallest abbr)."""
    kinds = F.array(
        F.struct(F.col("abbr").alias("surface"), F.col("enforce").alias("enforce")),
        F.struct(F.col("full").alias("surface"), F.lit(True).alias("enforce")),
    )
    more = F.transform(F.coalesce("match", F.array().cast("array<string>")), lambda m: F.struct(m.alias("surface"), F.col("enforce").alias("enforce")))
    each = products.select("abbr", "class", F.explode(F.concat(kinds, more)).alias("x")).select("abbr", "class", F.trim("x.surface").alias("surface"), F.coalesce("x.enforce", F.lit(True)).alias("enforce")).where("surface <> ''")
    told = each.groupBy("surface").agg(F.min_by("class", "abbr").alias("class"), F.bool_and("enforce").alias("enforce"))
    return with_collisions(told, "surface", words)


def casing_swaps(terms: DataFrame) -> DataFrame:
    """(surface) whose casing can be enforced token by token: one token, not opted out, no ordinary word."""
    return terms.where(~F.contains("surface", F.lit(" ")) & F.col("enforce") & ~F.col("collides")).select("surface")


def documented_in(resolved: DataFrame) -> DataFrame:
    """resolved(doc, node) -> edges (src, rel, dst) from a node to each document that it is resolved in."""
    return resolved.select(F.col("node").alias("src"), F.lit("documented-in").alias("rel"), F.concat(F.lit("doc/"), F.col("doc").cast("string")).alias("dst")).distinct()


def partition_edges(edges: DataFrame, registered: list[str]) -> tuple[DataFrame, DataFrame]:
    """Edges of registered kinds, and the others."""
    known = F.col("rel").isin(registered)
    return edges.where(known), edges.where(~F.coalesce(known, F.lit(False)))


def entity_quality(entities: DataFrame, vocabulary: DataFrame, policy: DataFrame) -> DataFrame:
    """entities(type, canonical), vocabulary(type, name), policy(type, status, floor) -> (type, status, total, joined, rate, ok).

    A type without policy is UNDECLARED and fails; only floor-verified types are measured; a type without entities is whole."""
    known = vocabulary.select("type", F.upper("name").alias("_name")).distinct()
    looked = entities.join(known.withColumn("_hit", F.lit(1)), (entities["type"] == known["type"]) & (F.upper(entities["canonical"]) == known["_name"]), "left").select(entities["type"], "_hit")
    counted = looked.groupBy("type").agg(F.count("*").alias("total"), F.count("_hit").alias("joined"))
    both = counted.join(policy, "type", "full_outer").na.fill(0, ["total", "joined"])
    measured = F.col("status") == "floor-verified"
    rate = F.when(measured, F.when(F.col("total") == 0, 1.0).otherwise(F.round(F.col("joined") / F.col("total"), 4))).otherwise(0.0)
    ok = F.when(F.col("status").isNull(), False).when(measured, rate >= F.col("floor")).otherwise(True)
    return both.select("type", F.coalesce("status", F.lit("UNDECLARED")).alias("status"), "total", F.when(measured, F.col("joined")).otherwise(0).alias("joined"), rate.alias("rate"), ok.alias("ok"))


def acronym_pairs(tables: DataFrame, rows: str = "rows") -> DataFrame:
    """(term, definition) of tables whose header names a term and its meaning; empty, repeated and overlong terms left out."""
    head = F.transform(F.col(rows)[0], F.lower)
    ok = (F.size(head) >= 2) & head[0].rlike("acronym|term|abbreviation") & head[1].rlike("definition|meaning|description|expansion")
    each = tables.where(ok).select(F.explode(F.slice(rows, 2, 100_000_000)).alias("r")).where(F.size("r") >= 2).select(F.trim(F.col("r")[0]).alias("term"), F.trim(F.col("r")[1]).alias("definition"))
    return each.where("term <> '' AND definition <> '' AND lower(term) <> lower(definition) AND length(term) <= 20")


def glossary_text(pairs: DataFrame) -> DataFrame:
    """One text of glossary lines, a term with its commonest definition (the larger among equals) each, by term."""
    counted = pairs.groupBy(F.upper("term").alias("_term"), "term", "definition").agg(F.count("*").alias("n"))
    best = counted.groupBy("_term").agg(F.max(F.struct("n", "term", "definition")).alias("x"))
    line = F.concat(F.lit("- **"), F.col("x.term"), F.lit("**: "), F.col("x.definition"))
    return best.agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_term", line.alias("line")))), lambda e: e["line"]), "\n").alias("text"))
