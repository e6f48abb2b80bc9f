"""Recurring patterns of a corpus: blocks, acronyms, structures and consensus of outlines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.functions.text import acronyms, block_key, strip_numbering
from quarry.operators import neardup
from quarry.session import spread, staged


#: Lines that are structure and no prose: links back and into contents, pictures, marks of extracted tables.
ARTIFACT = r"(?i)^\s*(?:(?:[-*+]\s+)?\[[^\]]*\]\(#[^)]*\)|<img\b[^>]*>|!\[[^\]]*\]\([^)]*\)|_?\[[^\]]*\]\(tables/[^)]*\)_?)\s*$"
BLANK = r"\n[ \t]*\n\s*"


def recurring_blocks(docs: DataFrame, key: str = "doc_id", text: str = "text", least: int = 3, sure: int = 10, phrase: int = 60) -> DataFrame:
    """Blocks (parted by blank lines) that stand in at least ``least`` documents: block key, documents, first-seen text, shape, disposition and grade.

    Blocks of artifact lines only are left out. A heading is a template's and stays, a short block of one line is a phrase to
    delete, a longer one boilerplate to refer to; a deletion is never sure on its number of documents alone. Blocks are first counted once a
    document, so copies within one document do not count."""
    each = spread(docs.select(key, text)).select(key, F.posexplode(F.split(F.col(text), BLANK)).alias("pos", "raw"))
    trimmed = each.select(key, "pos", F.regexp_replace("raw", r"^[ \t\n\r\x0B\f]+|[ \t\n\r\x0B\f]+$", "").alias("raw")).where("raw <> ''")
    told = trimmed.where(F.exists(F.split("raw", "\n"), lambda x: ~x.rlike(ARTIFACT) & (F.trim(x) != "")) & ~F.regexp_replace("raw", r"\s*\n\s*", " ").rlike(ARTIFACT))
    keyed = told.select(key, "pos", "raw", block_key(F.col("raw")).alias("block"))
    found = keyed.groupBy("block").agg(F.countDistinct(key).alias("documents"), F.min_by("raw", F.struct(key, "pos")).alias("sample"), F.min(key).alias("first")).where(F.col("documents") >= least)
    heading, short = F.col("sample").rlike("^#+ "), ~F.col("sample").contains("\n") & (F.length("sample") <= phrase)
    shaped = found.withColumn("shape", F.when(heading, "template").when(short, "phrase").otherwise("boilerplate"))
    disposition = F.when(F.col("shape") == "template", "retain").when(F.col("shape") == "phrase", "delete").otherwise("reference")
    return shaped.withColumn("disposition", disposition).withColumn("grade", F.when((F.col("documents") >= sure) & (F.col("shape") != "phrase"), "auto").otherwise("review"))


def glossary(docs: DataFrame, stop: list[str], key: str = "doc_id", text: str = "text", least: int = 3) -> DataFrame:
    """Acronyms that stand in at least ``least`` documents."""
    each = docs.select(key, F.explode(acronyms(F.col(text))).alias("term")).where(~F.col("term").isin(stop))
    return each.groupBy("term").agg(F.countDistinct(key).alias("documents")).where(F.col("documents") >= least)


def most_common(rows: DataFrame, group: str, value: str) -> DataFrame:
    """The commonest value of each group, the larger among equals."""
    counted = rows.groupBy(group, value).agg(F.count("*").alias("n"))
    return counted.groupBy(group).agg(F.max(F.struct("n", value)).alias("x")).select(group, F.col(f"x.{value}").alias(value), F.col("x.n").alias("n"))


def consensus(outline: DataFrame, members: str, title: str, level: str, pos: str, admit: float = 0.25, required: float = 0.5) -> DataFrame:
    """Titles that enough members share: number of members, mean position, level, whether required or repeated."""
    total = outline.agg(F.countDistinct(members).alias("total"))
    per = outline.groupBy(title, members).agg(F.count("*").alias("times"), F.min(pos).alias("pos"), F.min(level).alias("level"))
    rows = per.groupBy(title).agg(F.count("*").alias("members"), F.round(F.avg("pos"), 6).alias("position"), F.min("level").alias("level"), F.max(F.col("times") > 1).alias("repeats"))
    out = rows.crossJoin(F.broadcast(total)).where(F.col("members") >= F.greatest(F.lit(2), F.ceil(F.col("total") * admit)))
    return out.withColumn("required", F.col("members") >= F.col("total") * required).drop("total")


def shared_urls(rows: DataFrame, url: str) -> DataFrame:
    return rows.withColumn("shared", F.count("*").over(Window.partitionBy(url)) > 1)


def structures(docs: DataFrame, pattern: str, key: str = "doc_id", text: str = "text", least: int = 3, shown: int = 8) -> DataFrame:
    """(label, documents, variants: the commonest spellings with their documents) of lines that a pattern with one group labels."""
    each = docs.select(key, F.explode(F.split(F.col(text), "\n")).alias("line")).select(key, F.regexp_extract("line", pattern, 1).alias("variant")).where("variant <> ''").withColumn("label", F.upper("variant")).distinct()
    spelled = each.groupBy("label", "variant").agg(F.count("*").alias("n"))
    place = F.row_number().over(Window.partitionBy("label").orderBy(F.desc("n"), "variant"))
    best = spelled.withColumn("place", place).where(F.col("place") <= shown).groupBy("label").agg(F.array_sort(F.collect_list(F.struct("place", "variant", "n"))).alias("variants"))
    return each.groupBy("label").agg(F.countDistinct(key).alias("documents")).where(F.col("documents") >= least).join(best, "label")


def _plain_titles(titles: Column) -> Column:
    return F.transform(titles, lambda t: block_key(strip_numbering(t)))


def structural_fingerprint(titles: Column) -> Column:
    """One digest of an outline: its titles in order, without numbers and case."""
    return F.sha2(F.array_join(_plain_titles(titles), "\n"), 256)


def scaffold_shingles(titles: Column, k: int = 2) -> Column:
    """Distinct runs of k titles; a shorter outline is one, an empty one has none."""
    # Plain titles are bound as a lambda variable, or they would be made again for each run.
    runs = F.transform(F.array(_plain_titles(titles)), lambda plain: F.transform(F.sequence(F.lit(1), F.greatest(F.size(plain) - k + 1, F.lit(1))), lambda i: F.array_join(F.slice(plain, i, k), " › ")))[0]
    return F.when(F.size(titles) == 0, F.array().cast("array<string>")).otherwise(F.array_distinct(runs))


def bare_markers(text: Column) -> Column:
    """Lines that hold only a list marker."""
    return F.regexp_count(text, F.lit(r"(?m)^[ \t]*(?:[0-9]+\.|[-*])[ \t]*$")).cast("long")


def cross_wraps(text: Column) -> Column:
    return F.regexp_count(text, F.lit(r"\[\[")).cast("long")


def routing_advice(docs: DataFrame, key: str = "doc_id", text: str = "text", least: int = 50) -> DataFrame:
    """(key, wraps, bare, suggested, reason) of documents that a cross-reference explosion broke, for another converter; the number of wraps decides."""
    counted = docs.select(key, cross_wraps(F.col(text)).alias("wraps"), bare_markers(F.col(text)).alias("bare")).where(F.col("wraps") >= least)
    reason = F.concat(F.col("wraps").cast("string"), F.lit(" wraps of cross-references broke lists into "), F.col("bare").cast("string"), F.lit(" bare markers"))
    return counted.select(key, "wraps", "bare", F.lit("layout").alias("suggested"), reason.alias("reason"))


def boilerplate_clusters(docs: DataFrame, key: str = "doc_id", text: str = "text", least: int = 3, sure: int = 10, phrase: int = 60, threshold: float = 0.8) -> DataFrame:
    """(block, documents, spellings, grade): near-identical lines as one, named by the spelling with most documents (the larger
    among equals); documents of all spellings count once, so that rare spellings may qualify together."""
    each = spread(docs.select(key, text)).select(key, F.explode(F.split(F.col(text), "\n")).alias("line"))
    blocks = each.where(F.length("line") > phrase).select(key, block_key(F.col("line")).alias("block")).where("block <> ''")
    # Blocks are told by 128 bits of them: their texts are moved once each, not once for every document.
    marks, by = [F.xxhash64(F.lit(n), "block").alias(f"_m{n}") for n in range(2)], ["_m0", "_m1"]
    keyed = staged(blocks.select(key, *marks).distinct(), "blocks-of-documents")
    spelled = blocks.select("block").distinct().select("block", *marks).join(keyed.groupBy(*by).agg(F.count("*").alias("n")), by)
    numbered = staged(spelled.withColumn("number", F.monotonically_increasing_id()), "blocks")
    grouped = staged(neardup.clusters(staged(neardup.minhash(numbered, "number", "block"), "block-signatures"), "number", threshold, 128), "block-clusters")
    named = numbered.join(grouped, "number")
    heads = named.groupBy("cluster").agg(F.max(F.struct("n", "block"))["block"].alias("block"), F.count("*").alias("spellings"))
    documents = keyed.join(named.select(*by, "cluster"), by).select(key, "cluster").distinct().groupBy("cluster").agg(F.count("*").alias("documents")).where(F.col("documents") >= least)
    return documents.join(heads, "cluster").select("block", "documents", "spellings", F.when(F.col("documents") >= sure, "auto").otherwise("review").alias("grade"))


def shared_titles(rows: DataFrame, group: str, member: str, title: str, admit: float = 0.25, required: float = 0.5) -> DataFrame:
    """(group, title, n, required): titles that enough members of a group share, a template's sections."""
    total = rows.groupBy(group).agg(F.countDistinct(member).alias("_total"))
    shared = rows.groupBy(group, title).agg(F.countDistinct(member).alias("n"))
    both = shared.join(total, group).where(F.col("n") >= F.greatest(F.lit(2), F.ceil(F.col("_total") * admit)))
    return both.withColumn("required", F.col("n") >= F.col("_total") * required).drop("_total")
