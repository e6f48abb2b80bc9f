"""Enrichment of raw inventory rows: page scans, names, identities, document types, titles and joins to bundles."""

from __future__ import annotations

import hashlib
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from quarry.functions.text import html_cells, image_targets, month_year, safe_component, strip_html, url_extension, url_host, without_versions
from quarry.operators.inventory import facet_distribution

#: Endings that make a link a document, and labels that are formats rather than titles.
FORMATS = ["pdf", "doc", "docx", "zip", "txt"]
LABELS = ["PDF", "DOC", "DOCX", "ZIP", "TXT"]
#: Fixed value: parts of a slug that tell a version and not the document.
VERSION_PART = r"(?i)^([0-9]+|p[0-9]+|v[0-9]+|r[0-9]+|patch|release|addendum|rev|ver|version|build)$"


def app_name_parts(raw: Column) -> Column:
    """(name, status, retired_on, code) of an application's name: its ending tells the status, trailing brackets the code."""
    archived = raw.rlike(r"(?i)\s*-\s*ARCHIVE\s*$")
    retired = raw.rlike(r"(?i)\s*-\s*DECOMMISSIONED\s*(.*?)\s*$")
    name = F.trim(F.when(archived, F.regexp_replace(raw, r"(?i)\s*-\s*ARCHIVE\s*$", "")).otherwise(F.regexp_replace(raw, r"(?i)\s*-\s*DECOMMISSIONED.*$", "")))
    return F.struct(
        name.alias("name"),
        F.when(archived, "archive").when(retired, "decommissioned").otherwise("active").alias("status"),
        F.when(retired & ~archived, F.regexp_extract(raw, r"(?i)-\s*DECOMMISSIONED\s*(.*?)\s*$", 1)).otherwise("").alias("retired_on"),
        F.trim(F.regexp_extract(name, r"\(([A-Z0-9+/ ]{1,20})\)\s*$", 1)).alias("code"),
    )


def linked_entries(pages: DataFrame, key: str, marker: str, parameter: str, html: str = "html") -> DataFrame:
    """(key, entry, url, name): links whose target holds marker, by a parameter of its query; the first of each entry, in page order.

    An entry whose first link has no name is left out."""
    found = F.arrays_zip(
        F.regexp_extract_all(html, F.lit(r'(?is)<a\s[^>]*?href="([^"]*)"[^>]*>.*?</a>'), F.lit(1)).alias("url"),
        F.regexp_extract_all(html, F.lit(r'(?is)<a\s[^>]*?href="[^"]*"[^>]*>(.*?)</a>'), F.lit(1)).alias("name"),
    )
    each = pages.select(key, F.posexplode(found).alias("pos", "a")).where(F.contains("a.url", F.lit(marker)))
    named = each.select(key, "pos", F.col("a.url").alias("url"), strip_html(F.col("a.name")).alias("name"), F.regexp_extract("a.url", rf"[?&]{parameter}=([^&#]*)", 1).alias("entry"))
    first = named.groupBy(key, "entry").agg(F.min_by(F.struct("url", "name"), "pos").alias("x"), F.min("pos").alias("pos"))
    return first.select(key, "entry", "x.url", "x.name").where("name <> ''")


def file_rows(pages: DataFrame, key: str, html: str = "html") -> DataFrame:
    """(key, row, url, title, label, said_on): links to documents in table rows of two cells or more; a page without any gives its links anywhere.

    A link that only names a format takes its title from the row's first other cell."""
    is_file = lambda u: url_extension(u).isin(FORMATS)
    links_of = lambda h: F.arrays_zip(F.regexp_extract_all(h, F.lit(r'(?is)<a\s[^>]*?href="([^"]*)"[^>]*>.*?</a>'), F.lit(1)).alias("url"), F.transform(F.regexp_extract_all(h, F.lit(r'(?is)<a\s[^>]*?href="[^"]*"[^>]*>(.*?)</a>'), F.lit(1)), strip_html).alias("text"))
    rows = pages.select(key, F.posexplode(F.regexp_extract_all(html, F.lit(r"(?is)<tr[^>]*>(.*?)</tr>"), F.lit(1))).alias("row", "tr")).select(key, "row", "tr", html_cells(F.col("tr")).alias("cells")).where(F.size("cells") >= 2)
    each = rows.select(key, "row", "cells", F.explode(links_of(F.col("tr"))).alias("a")).where(is_file(F.col("a.url")))
    plain = F.upper("a.text").isin(LABELS)
    other = F.get(F.filter("cells", lambda c: (c != "") & ~F.upper(c).isin(LABELS)), F.lit(0))
    file = F.regexp_extract(F.regexp_replace("a.url", "[?#].*$", ""), r"([^/]*)$", 1)
    title = F.when(plain, F.coalesce(other, file)).otherwise(F.coalesce(F.nullif(F.col("a.text"), F.lit("")), F.col("cells")[1]))
    said = F.get(F.filter(F.transform("cells", month_year), lambda d: d.isNotNull()), F.lit(0))
    told = each.select(key, F.col("row").cast("long").alias("row"), "a.url", title.alias("title"), F.when(plain, F.upper("a.text")).otherwise(F.col("cells")[0]).alias("label"), said.alias("said_on"))
    bare = pages.join(told.select(key).distinct(), key, "left_anti").select(key, F.posexplode(links_of(F.col(html))).alias("row", "a")).where(is_file(F.col("a.url")))
    return told.unionByName(bare.select(key, F.col("row").cast("long").alias("row"), "a.url", F.col("a.text").alias("title"), F.lit("").alias("label"), F.lit(None).cast("string").alias("said_on")))


def flatten(sections: DataFrame) -> DataFrame:
    """sections(section, apps: array of (app, docs: array of (doc, ...))) -> a row for each document with its section and application."""
    apps = sections.select("section", F.explode("apps").alias("a"))
    return apps.select("section", "a.app", F.explode("a.docs").alias("d")).select("section", "app", "d.*")


def read_records(texts: DataFrame, column: str, schema: StructType, in_format: str = "docx") -> DataFrame:
    """Records from JSON texts, unknown keys passed over, with the reason why a record's format is out of scope."""
    rows = texts.select(F.from_json(column, schema).alias("r")).select("r.*")
    return rows.withColumn("out_of_scope_reason", F.when(F.col("doc_format") == in_format, "").otherwise(F.concat(F.lit("format "), F.coalesce(F.nullif(F.col("doc_format"), F.lit("")), F.lit("unknown")))))


def slug_stem(slug: Column) -> Column:
    """A document's slug without the parts that tell its version."""
    return F.array_join(F.filter(F.split(slug, "_"), lambda p: ~p.rlike(VERSION_PART)), "_")


def doc_id(app: Column, slug: Column) -> Column:
    return F.concat(app, F.lit(":"), slug)


def anchor_key(app: Column, package: Column, kind: Column, slug: Column) -> Column:
    """What all versions of a document share; empty where it has no kind, without the stem where nothing else is left of the slug."""
    return F.when(kind == "", "").otherwise(F.concat_ws(":", app, package, kind, F.nullif(slug_stem(slug), F.lit(""))))


def bundle_path(app: Column, slug: Column) -> Column:
    return F.concat(safe_component(app), F.lit("/"), safe_component(slug))


def anchor_path(app: Column, package: Column, kind: Column, slug: Column) -> Column:
    """The folder of a document's versions, the same for all of them."""
    stem = F.coalesce(F.nullif(slug_stem(slug), F.lit("")), F.concat_ws("_", package, kind))
    return F.when(kind == "", bundle_path(app, slug)).otherwise(bundle_path(app, F.lower(stem)))


def body_path(folder: Column, root: str = "gold") -> Column:
    return F.concat(F.lit(f"{root}/"), folder, F.lit("/body.md"))


def with_alias(rows: DataFrame, key: str, aliases: DataFrame) -> DataFrame:
    """rows with the key's curated spelling (aliases(key, name)), its own where there is none."""
    named = aliases.select(F.col("key").alias(key), F.col("name").alias("_name"))
    return rows.join(named, key, "left").withColumn(key, F.coalesce("_name", key)).drop("_name")


def system_parts(system: Column) -> Column:
    """(platform, companions) of a system named like "A + B + C"."""
    parts = F.transform(F.split(system, r"\+"), lambda p: F.trim(p))
    return F.struct(parts[0].alias("platform"), F.filter(F.slice(parts, F.lit(2), F.size(parts)), lambda p: p != "").alias("companions"))


def classify_system(rows: DataFrame, app: str, systems: DataFrame, dependent: list[str], product: str = "COTS") -> DataFrame:
    """rows with system (unclassified where systems(app, system) has none) and bought: an application that is told to depend on
    a product, or whose companions name it."""
    known = rows.join(systems.select(F.col("app").alias(app), "system"), app, "left").withColumn("system", F.coalesce("system", F.lit("unclassified")))
    companion = F.exists(system_parts(F.col("system"))["companions"], lambda c: F.upper(c) == product)
    return known.withColumn("bought", F.col(app).isin(dependent) | companion)


def normal_date(raw: Column) -> Column:
    """"DEC 2019" as 2019-12; anything else as it is, null as empty."""
    short = F.trim(raw).rlike(r"^[A-Za-z]{3}\s+[0-9]{4}$")
    return F.coalesce(F.when(short, F.coalesce(month_year(F.trim(raw)), raw)).otherwise(raw), F.lit(""))


def noise_kind(url: Column, form_hosts: list[str], root: str) -> Column:
    """Why a shared URL is no document: a form's host, or a path outside root; else empty."""
    path = F.regexp_replace(F.regexp_replace(url, "[?#].*$", ""), "^[a-zA-Z]+://[^/]*", "")
    return F.when(url_host(url).isin(form_hosts), "form").when(~F.contains(path, F.lit(root)), "reference").otherwise("")


def companions(rows: DataFrame, key: str, url: str) -> DataFrame:
    """(key, companion): for each row the first URL that differs from its own only in its ending, null if there is none.

    For each base the first URL of each ending is kept (a few), and joined back."""
    ending, base = url_extension(F.col(url)), F.regexp_replace(url, r"\.[A-Za-z0-9]+$", "")
    named = rows.select(key, base.alias("_base"), ending.alias("_ending"))
    firsts = rows.groupBy(base.alias("_base"), ending.alias("_ending")).agg(F.min(url).alias("url")).groupBy("_base").agg(F.sort_array(F.collect_list(F.struct("url", "_ending"))).alias("all"))
    return named.join(firsts, "_base").select(key, F.get(F.filter("all", lambda x: x["_ending"] != F.col("_ending")), F.lit(0))["url"].alias("companion"))


def first_rule(text: Column, rules: list[tuple[str, str]], otherwise: Column | None = None) -> Column:
    """The name of the first pattern, in the given order, that the text matches."""
    out = F.lit("") if otherwise is None else otherwise
    for pattern, name in reversed(rules):
        out = F.when(text.rlike(pattern), name).otherwise(out)
    return out


def doc_type(title: Column, filename: Column, rules: list[tuple[str, str]], endings: dict[str, str]) -> Column:
    """A document's type by its title, else by the ending of its file's stem."""
    stem = F.lower(F.regexp_extract(F.regexp_replace(filename, r"\.[A-Za-z0-9]+$", ""), r"[_\-]([A-Za-z]{2,8})$", 1))
    known = F.create_map(*[F.lit(x) for pair in sorted(endings.items()) for x in pair]) if endings else F.create_map().cast("map<string,string>")
    return first_rule(title, rules, F.coalesce(known[stem], F.lit("")))


def subject(title: Column, prefix: Column, label: Column) -> Column:
    """What a title says beyond its package prefix and type label; empty where only a year, a version or marks are left."""
    without = lambda c, part: F.when(F.coalesce(part, F.lit("")) == "", c).otherwise(F.replace(c, part, F.lit("")))
    rest = F.trim(F.regexp_replace(without(without(title, prefix), label), r"\s+", " "))
    bare = F.trim(F.regexp_replace(rest, r"^[\s,\-]+|[\s,\-]+$", ""))
    empty = bare.rlike(r"^[0-9]{4}$") | bare.rlike(r"^[0-9.]+$") | bare.rlike(r"^[*\s,\-]*$") | bare.rlike(r"^\*[0-9]+")
    return F.when(empty, "").otherwise(bare)


def canonical_labels(rows: DataFrame, kind: str, label: str, labels: DataFrame) -> DataFrame:
    """rows with the type's one label (labels(kind, name)); a label that said something else becomes the subtitle."""
    known = rows.join(F.broadcast(labels.select(F.col("kind").alias(kind), F.col("name").alias("_name"))), kind, "left")  # a registry of types
    drift = F.col("_name").isNotNull() & (F.lower(label) != F.lower("_name")) & (F.col(label) != "")
    return known.withColumn("subtitle", F.when(drift, F.col(label)).otherwise("")).withColumn(label, F.coalesce("_name", label)).drop("_name")


def preferred(rows: DataFrame, key: str, better: Column, order: str) -> DataFrame:
    """One row of each key: a better one if there is any, else the first in order."""
    rest = [c for c in rows.columns if c != key]
    best = rows.groupBy(key).agg(F.min_by(F.struct(*rest), F.struct(F.when(better, 0).otherwise(1), order)).alias("r"))
    return best.select(key, *[F.col(f"r.{c}").alias(c) for c in rest])


def inventory_status(rows: DataFrame, key: str, in_scope: Column, order: str, shown: list[str], acquired: DataFrame, status: str = "status") -> DataFrame:
    """One row of each document: its first row in scope, else its first; the status of its acquisition, not_acquired, or
    out_of_scope where no row of it is in scope."""
    one = preferred(rows.select(key, order, *shown, in_scope.alias("_scope")), key, F.col("_scope"), order)
    told = one.join(acquired.select(key, F.col(status).alias("_status")), key, "left")
    return told.select(key, *shown, F.when(~F.col("_scope"), "out_of_scope").otherwise(F.coalesce("_status", F.lit("not_acquired"))).alias("status"))


def status_summary(rows: DataFrame, order: list[str], status: str = "status") -> DataFrame:
    """(status, n, place): the total first, then counts in the given order; statuses that do not occur are left out."""
    place = F.array_position(F.array(*map(F.lit, ["total", *order])), F.coalesce(F.col(status), F.lit("total")))
    counted = rows.rollup(status).agg(F.count("*").alias("n"), F.grouping(status).alias("_all"))
    told = counted.select(F.when(F.col("_all") == 1, "total").otherwise(F.col(status)).alias("status"), "n", F.when(F.col("_all") == 1, F.lit(1).cast("long")).otherwise(place).alias("place"))
    return told.where("place > 0")


def gate_summary(rows: DataFrame, code: str, genuine: Column, in_scope: Column, kept: Column) -> DataFrame:
    """(code, genuine, admitted, out_of_scope, omitted): what a gate does to each type of document, and the total (code null)."""
    counts = [F.count_if(c).alias(n) for n, c in (("genuine", genuine), ("admitted", genuine & in_scope & kept), ("out_of_scope", genuine & ~in_scope), ("omitted", genuine & in_scope & ~kept))]
    return rows.rollup(code).agg(*counts)


def is_zip(content: Column) -> Column:
    """Whether a payload begins as a zip archive does."""
    return F.substring(content, 1, 4) == F.lit(b"PK\x03\x04")


def selection_fingerprint(everything: bool = False, **dimensions: list[str] | None) -> str:
    """One digest of a selection, however its dimensions and values are ordered or repeated."""
    told = [f"{k}={','.join(sorted(set(v)))}" for k, v in sorted(dimensions.items()) if v]
    return hashlib.sha256("\n".join(["all" if everything else "some", *told]).encode()).hexdigest()


def selection_digest(everything: Column, **dimensions: Column) -> Column:
    """selection_fingerprint() of selections in rows, with array columns as dimensions; an empty or null one narrows nothing."""
    told = [F.when(F.size(values) > 0, F.concat(F.lit(f"{name}="), F.array_join(F.array_sort(F.array_distinct(values)), ","))) for name, values in sorted(dimensions.items())]
    return F.sha2(F.concat_ws("\n", F.when(everything, "all").otherwise("some"), *told), 256)


def facet_catalog(rows: DataFrame, facets: list[str]) -> DataFrame:
    """(facet, value, n, place): values of each facet, commonest first; as few rows as there are values."""
    place = F.row_number().over(Window.partitionBy("facet").orderBy(F.desc("n"), "value"))
    return facet_distribution(rows, facets).withColumn("place", place.cast("long"))


def counts(named: dict[str, DataFrame], by: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """(name, value, n): sizes of frames, and sizes by a column's values."""
    whole = [df.agg(F.count("*").alias("n")).select(F.lit(name).alias("name"), F.lit("").alias("value"), "n") for name, df in named.items()]
    parts = [df.groupBy(F.col(c).cast("string").alias("value")).agg(F.count("*").alias("n")).select(F.lit(name).alias("name"), "value", "n") for name, (df, c) in by.items()]
    return reduce(DataFrame.unionByName, whole + parts)


def crawl_yield(rows: DataFrame, section: str) -> DataFrame:
    """(section, n) and the total under null."""
    return rows.rollup(section).agg(F.count("*").alias("n"))


def profile_tags(rows: DataFrame, app: str, kind: str, by_app: DataFrame, by_kind: DataFrame) -> DataFrame:
    """rows with tags: app_user by application, doc_user by type, where "operator" stands for the application's user; empty ones left out."""
    one = rows.join(F.broadcast(by_app.select(F.col("app").alias(app), F.col("user").alias("_app"))), app, "left")  # registries
    both = one.join(F.broadcast(by_kind.select(F.col("kind").alias(kind), F.col("user").alias("_doc"))), kind, "left")
    doc = F.when(F.col("_doc") == "operator", F.col("_app")).otherwise(F.col("_doc"))
    tags = F.map_filter(F.create_map(F.lit("app_user"), F.col("_app"), F.lit("doc_user"), doc), lambda k, v: F.coalesce(v, F.lit("")) != "")
    return both.withColumn("tags", tags).drop("_app", "_doc")


def frontmatter_of(**fields: Column) -> Column:
    """The fields that are not empty, as a map."""
    return F.map_filter(F.create_map(*[x for k, c in fields.items() for x in (F.lit(k), c.cast("string"))]), lambda k, v: F.coalesce(v, F.lit("")) != "")


#: What kind of reading a document's type is.
MODES = {"DG": "reference", "PM": "reference", "TM": "how-to", "SMG": "how-to", "UM": "how-to", "UG": "how-to", "IG": "how-to", "CG": "how-to", "SG": "reference", "TRG": "tutorial", "RN": "reference"}


def reading_mode(code: Column) -> Column:
    """The mode of a document type, reference where it is not known."""
    return F.coalesce(F.create_map(*[F.lit(x) for pair in MODES.items() for x in pair])[F.upper(F.coalesce(code, F.lit("")))], F.lit("reference"))


def needs_layout_converter(ending: Column, key: Column, routed: list[str]) -> Column:
    """Whether a document goes to the converter that reads layouts: it is a PDF, or its key is on the list."""
    return (F.lower(ending) == "pdf") | key.isin(routed)


def display_titles(rows: DataFrame, title: str, app: str, products: DataFrame) -> DataFrame:
    """rows with shown: the title without versions, behind the abbreviation of the longest name of the application's products
    (products(app, abbr, alias)) that begins it; a title that no name begins stays as it is."""
    bare = rows.withColumn("_bare", without_versions(F.col(title)))
    names = products.select(F.col("app").alias(app), "abbr", "alias").where("alias <> ''").groupBy(app).agg(F.collect_set(F.struct("alias", "abbr")).alias("_names"))  # an application's few products
    known = bare.join(F.broadcast(names), app, "left")
    fits = F.filter(F.coalesce("_names", F.array().cast("array<struct<alias:string,abbr:string>>")), lambda n: F.startswith(F.lower("_bare"), F.lower(n["alias"])) & ~F.substr(F.col("_bare"), F.length(n["alias"]) + 1, F.lit(1)).rlike("[A-Za-z0-9]"))
    best = F.array_max(F.transform(fits, lambda n: F.struct(F.length(n["alias"]).alias("n"), n["abbr"].alias("abbr"))))
    rest = F.regexp_replace(F.substr(F.col("_bare"), best["n"] + 1), r"^[\s,;:\-–—()]+", "")
    shown = F.when(best.isNull(), F.col("_bare")).when(rest == "", best["abbr"]).otherwise(F.concat(best["abbr"], F.lit(" — "), rest))
    return known.withColumn("shown", shown).drop("_bare", "_names")


def longest_known_prefix(rows: DataFrame, key: str, text: str, vocabulary: DataFrame) -> DataFrame:
    """(key, member): the longest run of words from the text's first on that the vocabulary(member) holds; rows without any are left out."""
    words = F.split(F.trim(F.col(text)), r"\s+")
    each = rows.select(key, F.explode(F.transform(F.sequence(F.lit(1), F.size(words)), lambda n: F.struct(n.alias("n"), F.array_join(F.slice(words, F.lit(1), n), " ").alias("member")))).alias("p")).select(key, "p.n", "p.member")
    return each.join(vocabulary.select("member").distinct(), "member").groupBy(key).agg(F.max_by("member", "n").alias("member"))


def asset_stats(docs: DataFrame, key: str, body: str, assets: DataFrame) -> DataFrame:
    """(key, images, found, bytes): images that a body names, each once, and those that assets(name, length) has."""
    each = docs.select(key, F.explode_outer(image_targets(F.col(body))).alias("name"))
    both = each.join(assets.select("name", "length"), "name", "left")
    return both.groupBy(key).agg(F.count("name").alias("images"), F.count("length").alias("found"), F.coalesce(F.sum("length"), F.lit(0)).alias("bytes"))


def table_kind(rows: Column, tokens: list[str], least: int = 12) -> Column:
    """Whether a table is for looking up (many rows, or a header that names a reference) or told along."""
    head = F.exists(rows[0], lambda c: F.lower(c).rlike("|".join(tokens)))
    return F.when((F.size(rows) >= least) | head, "reference").otherwise("narrative")


def validation(findings: dict[str, DataFrame], blocking: list[str]) -> DataFrame:
    """(kind, findings, blocks) of several frames of findings; only some kinds block."""
    told = [df.agg(F.count("*").alias("findings")).select(F.lit(k).alias("kind"), "findings", (F.lit(k in blocking) & (F.col("findings") > 0)).alias("blocks")) for k, df in sorted(findings.items())]
    return reduce(DataFrame.unionByName, told)
