"""Templates: outlines clustered within document type and era, one ordered schema for each cluster, and its use on bodies.

Documents were poured into templates; those of one template share most of their section titles in order. Outlines become
MinHash signatures over runs of two titles (without numbers and case), near ones of the same type and era are joined,
and the members of a cluster are lined up by title: which sections most of them have, in which order and spellings.
Equal outlines are one signature, so that a type of a million equal documents is one row of the comparison; schemas are counted by
partial aggregation, by cluster, title and document first.
"""

from __future__ import annotations

import re
from collections.abc import Collection, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.functions.text import block_key, decade, first_keyword, month_year, strip_numbering, strip_tags
from quarry.operators import bodies, mining, neardup
from quarry.operators.normalize import heading_lines
from quarry.session import ship, staged
from quarry.sources.markdown import sections

#: Likeness of outlines, documents of a template, of a sure one, samples shown, and lines of a title page.
LIKE, LEAST, SURE, SAMPLE, TITLE_PAGE, COVER = 0.6, 3, 10, 5, 40, 80
#: Shares of the members from which a section belongs to the schema, and is required.
ADMIT, REQUIRED = 0.25, 0.5
#: Words of a title and the role of its section, the first that stands in the title.
ROLES = [
    ("glossary", "glossary"), ("acronym", "glossary"), ("revision history", "revision-history"), ("back-out", "back-out"), ("back out", "back-out"),
    ("rollback", "back-out"), ("roll back", "back-out"), ("install", "installation"), ("deployment", "installation"), ("troubleshoot", "troubleshooting"),
    ("introduction", "orientation"), ("overview", "orientation"), ("orientation", "orientation"), ("purpose", "orientation"), ("scope", "orientation"),
    ("getting started", "orientation"),
]
#: Fixed value: the imprint of covers.
IMPRINT = "department of veterans affairs"
BUCKET = ["doc_type", "era"]


def era(body: Column) -> Column:
    """The decade of the first month and year on the title page, else unknown."""
    return decade(F.array_join(F.slice(F.split(body, "\n", -1), 1, TITLE_PAGE), "\n"))


def outlines(docs: DataFrame) -> DataFrame:
    """docs(doc_id, doc_type, body) -> (doc_id, doc_type, era, outline): headings below the title, in order, as (level, title)."""
    found = sections(docs.select(F.col("doc_id").alias("doc_key"), "body")).where("level >= 2")
    rows = found.groupBy("doc_key").agg(F.transform(F.array_sort(F.collect_list(F.struct("seq", "level", "title"))), lambda x: F.struct(x["level"].cast("int").alias("level"), x["title"].alias("title"))).alias("outline"))
    joined = docs.select("doc_id", "doc_type", era(F.col("body")).alias("era")).join(rows.withColumnRenamed("doc_key", "doc_id"), "doc_id", "left")
    return joined.withColumn("outline", F.coalesce("outline", F.array().cast("array<struct<level:int,title:string>>")))


def clustered(docs: DataFrame, threshold: float = LIKE, permutations: int = 128) -> DataFrame:
    """docs(doc_id, doc_type, era, outline) with cluster: the smallest doc_id that outlines of one type and era are joined to.

    Rows without a type or a doc_id are left out; a null era counts as unknown."""
    known = docs.where("doc_type IS NOT NULL AND doc_id IS NOT NULL").select("doc_id", "doc_type", F.coalesce("era", F.lit("unknown")).alias("era"), "outline")
    shingled = mining.scaffold_shingles(F.transform(F.filter("outline", lambda x: F.trim(x["title"]) != ""), lambda x: x["title"]))
    # Equal outlines are signed once; they are told by 128 bits of their runs.
    marks = [F.xxhash64(F.lit(n), F.array_sort("runs")).alias(f"_m{n}") for n in range(2)]
    told = staged(known.withColumn("runs", shingled).select("*", *marks), "outlines")
    by = ["_m0", "_m1", *BUCKET]
    heads = staged(told.groupBy(*by).agg(F.min("doc_id").alias("head")), "outline-heads")
    sets = told.join(heads, [*by]).where("doc_id = head").dropDuplicates(by).select("head", *BUCKET, F.transform("runs", neardup.signed_hash).alias("hashes"))
    signed = staged(neardup.minhash_of(sets, permutations), "outline-signatures")
    named = heads.join(neardup.clusters(signed, "head", threshold, permutations, within=BUCKET), "head").drop("head")
    return told.join(named, by).select(*known.columns, "cluster")


def _escaped(core: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(core, r"([\\.^$|?*+(){}\[\]])", r"\\$1"), " ", r"\\s+")


def schemas(members: DataFrame, least: int = LEAST, sure: int = SURE) -> DataFrame:
    """members(doc_id, doc_type, era, cluster, outline) -> one row for each cluster of at least ``least`` documents:
    template_id, doc_type, era, doc_count, grade, sample_doc_ids, and sections in the order of their mean places.

    A section is known by its title without number and case. It is admitted if a quarter of the members and two at least have
    it, required if half have it, repeatable if it stands twice in any; its title and level are the commonest (of equals the one
    of the smallest doc_id, first), its pattern allows a number in front if a spelling has one."""
    sized = members.groupBy(*BUCKET, "cluster").agg(F.count("*").alias("doc_count")).where(F.col("doc_count") >= least)
    each = members.join(sized.select("cluster"), "cluster").select("cluster", "doc_id", F.posexplode("outline").alias("pos", "s"))
    each = each.select("cluster", "doc_id", "pos", "s.level", "s.title", block_key(strip_numbering(F.trim("s.title"))).alias("core"))
    at = F.struct("doc_id", "pos")
    spelled = each.groupBy("cluster", "core", "title").agg(F.count("*").alias("n"), F.min(at).alias("first"))
    titles = spelled.groupBy("cluster", "core").agg(F.min_by("title", F.struct((-F.col("n")).alias("n"), "first")).alias("title"), F.bool_or(F.col("title").rlike(r"^\s*\d+(?:\.\d+)*\.?\s+")).alias("numbered"))
    once = each.groupBy("cluster", "core", "doc_id").agg(F.count("*").alias("times"), F.min(F.struct("pos", "level")).alias("x"))
    levels = once.groupBy("cluster", "core", "x.level").agg(F.count("*").alias("n"), F.min(F.struct("doc_id", "x.pos")).alias("first"), F.sum("x.pos").alias("places"), F.max("times").alias("times"))
    rows = levels.groupBy("cluster", "core").agg(
        F.sum("n").alias("documents"), F.min_by("level", F.struct((-F.col("n")).alias("n"), "first")).alias("level"), F.min("first").alias("first"),
        (F.sum("places") / F.sum("n")).alias("place"), (F.max("times") > 1).alias("repeatable"),
    )
    size = F.col("doc_count")
    held = rows.join(titles, ["cluster", "core"]).join(sized, "cluster").where(F.col("documents") >= F.greatest(F.lit(2), F.ceil(size * ADMIT)))
    slug = F.regexp_replace(F.regexp_replace(F.lower(F.trim("title")), r"[^\p{L}\p{N}_\- ]+", ""), " ", "-")
    pattern = F.concat(F.lit("(?i)^"), F.when(F.col("numbered"), r"(?:\d+(?:\.\d+)*\.?\s+)?").otherwise(""), _escaped(F.col("core")), F.lit("$"))
    section = F.struct(
        "place", "first", F.when(slug == "", "section").otherwise(slug).alias("section_id"), "title", pattern.alias("title_pattern"), "level", (F.col("documents") >= size * REQUIRED).alias("required"),
        "repeatable", first_keyword(F.col("title"), ROLES).alias("semantic_role"), (F.col("level") <= 3).alias("toc_level"), "documents",
    )
    # A cluster has at most four times as many admitted sections as its members have on average.
    listed = held.groupBy("cluster").agg(F.array_sort(F.collect_list(section)).alias("sections"))
    fields = ("section_id", "title", "title_pattern", "level", "required", "repeatable", "semantic_role", "toc_level", "documents")
    listed = listed.withColumn("sections", F.transform("sections", lambda s: F.struct(*[s[f].alias(f) for f in fields])))
    place = F.row_number().over(Window.partitionBy("cluster").orderBy("doc_id"))
    samples = members.select("cluster", "doc_id", place.alias("place")).where(F.col("place") <= SAMPLE).groupBy("cluster").agg(F.sort_array(F.collect_list("doc_id")).alias("sample_doc_ids"))
    none = F.array().cast(listed.schema["sections"].dataType)
    whole = sized.join(listed, "cluster", "left").join(samples, "cluster").withColumn("sections", F.coalesce("sections", none))
    print_ = F.sha2(F.concat(F.array_join(F.transform("sections", lambda s: block_key(s["title"])), "\n"), F.when(F.size("sections") > 0, "\n").otherwise("")), 256)
    name = F.concat_ws(":", *BUCKET, F.substring(print_, 1, 8))
    return whole.select(name.alias("template_id"), *BUCKET, "cluster", "doc_count", F.when(size >= sure, "auto").otherwise("review").alias("grade"), "sample_doc_ids", "sections")


def mine(docs: DataFrame, least: int = LEAST, sure: int = SURE, threshold: float = LIKE) -> DataFrame:
    """Templates of docs(doc_id, doc_type, era, outline)."""
    return schemas(staged(clustered(docs, threshold), "outline-clusters"), least, sure)


# Use on bodies


def strip_scaffold(body: str, titles: Collection[str]) -> str:
    """Without the template's sections that nothing was filled into: neither text nor a heading below them; blank lines go along."""
    lines = body.split("\n")
    levels = {i: len(m[1]) for i, m in heading_lines(lines)}
    kept: list[str] = []
    start = 0  # of the lines that are not yet kept or dropped
    for i, level in levels.items():
        title = " ".join(lines[i].lstrip("#").lower().split())
        if title == "contents" or title not in titles:
            continue
        # The section is empty if the first line below that is not blank ends it.
        stop = i + 1
        while stop < len(lines) and not lines[stop].strip():
            stop += 1
        if stop == len(lines) or levels.get(stop, 7) <= level:
            kept += lines[start:i]
            start = stop
    return "\n".join([*kept, *lines[start:]]) if start else body


_MONTH = r"(?:jan(?:uary)?|feb(?:ruary)?|mar(?:ch)?|apr(?:il)?|may|june?|july?|aug(?:ust)?|sept?(?:ember)?|oct(?:ober)?|nov(?:ember)?|dec(?:ember)?)"
_DATED = re.compile(rf"(?i)\b{_MONTH}\.?,?\s+\d{{4}}\b")
_SIGNAL = re.compile(rf"(?i){IMPRINT}|intentionally left blank|<img\b|!\[")
_YEAR = re.compile(r"\d{4}")
_KNOWN = ("contents", "table of contents", "revision history", "document revision history")
_IMAGE = re.compile(r"[ \t]*(?:<img\b[^>]*>|!\[[^\]]*\]\([^)]*\))[ \t]*")


def _furniture(line: str) -> bool:
    """The imprint, with or without an office behind it, or a short line with a date; as a heading too."""
    shown = bodies.untagged(line)
    if "department" in (low := shown.lower()) and " ".join(re.sub(r"[^a-z0-9]", " ", low).split()).startswith(IMPRINT):
        return True
    return bool(_YEAR.search(shown)) and len(shown.strip()) < 50 and bool(_DATED.search(shown))


def _entry(line: str) -> bool:
    """A heading without marks that a cover ends with, or an entry of contents; most lines have no sign of either."""
    low = line.lower()
    if ("contents" in low or "revision history" in low) and re.sub(r"^[>#* ]+|[*: ]+$", "", line).lower() in _KNOWN:
        return True
    return ("](#" in line or "..." in line or "…" in line or "|" in line) and bodies.toc_entry(line) is not None


def _cover(lines: list[str]) -> int:
    """Where the cover ends: the first heading, revision heading or entry of contents that is no furniture, within COVER lines; 0 if there is
    none, or the first line is one."""
    first = lines[: COVER + 1]
    headings = {i for i, _ in heading_lines(first)}
    return next((i for i, x in enumerate(first) if (i in headings or _entry(x)) and not _furniture(x)), 0)


def title_block(title: str, version: str, patch: str, published: str, url: str) -> list[str]:
    """The lines that stand for a cover."""
    facts = [f"{name} {value}" for name, value in (("Version", version), ("Patch", patch), ("Published", published)) if value]
    return ([f"**{title}**"] if title else []) + (["", f"_{' · '.join(facts)}_"] if facts else []) + (["", f"Source: <{url}>"] if url else [])


def without_cover_images(body: str) -> str:
    """Images that stand alone on a line of the cover go; where no heading ends it, the cover is the blank, image and furniture lines at the start."""
    if "![" not in body and "<img" not in body:
        return body
    lines = body.split("\n")
    end = _cover(lines)
    if not end:
        end = next((i for i, x in enumerate(lines[:TITLE_PAGE]) if x.strip() and not _IMAGE.fullmatch(x) and not _furniture(x)), min(TITLE_PAGE, len(lines)))
    return "\n".join([*(x for x in lines[:end] if not _IMAGE.fullmatch(x)), *lines[end:]])


def standard_title_page(body: str, title: str = "", version: str = "", patch: str = "", published: str = "", url: str = "") -> str:
    """The cover as a block of known facts, if its date was taken before (published); else the body as it is.

    A cover that a heading ends within COVER lines, and that shows signs of one, is replaced whole; elsewhere only the furniture of
    the title page goes."""
    if not published:
        return body
    lines = body.split("\n")
    end = _cover(lines)
    if end and any(_SIGNAL.search(x) or _DATED.search(x) for x in lines[:end]):
        return "\n".join([*title_block(title, version, patch, published, url), "", *lines[end:]]).lstrip("\n")
    return "\n".join([*(x for x in lines[:TITLE_PAGE] if not _furniture(x)), *lines[TITLE_PAGE:]])


def applied(docs: DataFrame, templates: DataFrame) -> DataFrame:
    """docs(doc_id, doc_type, era, body, title, version, patch, url), templates of mine() -> (doc_id, template_id, published, body).

    Of several templates of a type and era that with most documents is taken (then by name). Documents without one keep their
    sections; every body gets its standard title page."""
    best = templates.groupBy(*BUCKET).agg(F.min_by(F.struct("template_id", F.transform("sections", lambda s: block_key(s["title"])).alias("titles")), F.struct((-F.col("doc_count")).alias("n"), "template_id")).alias("t"))
    head = F.array_join(F.slice(F.split("body", "\n", -1), 1, TITLE_PAGE), "\n")
    facts = [F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("title", "version", "patch", "url")]
    rows = docs.withColumn("era", F.coalesce("era", F.lit("unknown"))).join(best, BUCKET, "left").select("doc_id", F.coalesce("t.template_id", F.lit("")).alias("template_id"), F.coalesce(F.array_join("t.titles", "\n"), F.lit("")).alias("titles"), month_year(head).alias("published"), F.coalesce("body", F.lit("")).alias("body"), *facts)
    ship(docs.sparkSession)

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            # A template's titles are of one line each, and are told apart once for a batch.
            told = part.column("titles").dictionary_encode()
            sets = [{x for x in t.split("\n") if x} for t in told.dictionary.to_pylist()]
            cover = (part.column(c).to_numpy(zero_copy_only=False).tolist() for c in ("body", "title", "version", "patch", "published", "url"))
            out = []
            for which, body, title, version, patch, published, url in zip(told.indices.to_numpy().tolist(), *cover, strict=True):
                body = without_cover_images(standard_title_page(body, title, version, patch, published or "", url))
                out.append(strip_scaffold(body, sets[which]) if sets[which] else body)
            yield pa.RecordBatch.from_arrays([*(part.column(c) for c in ("doc_id", "template_id", "published")), pa.array(out, pa.string())], names=["doc_id", "template_id", "published", "body"])

    return rows.mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, template_id string, published string, body string")
