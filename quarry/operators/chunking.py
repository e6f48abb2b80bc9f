"""From sections to searchable chunks: small leaves merged, tables windowed by rows, titles folded, bodies profiled."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.operators.normalize import HARD, TARGET
from quarry.sources.markdown import lines

#: Fixed value: how a table that stands in a file of its own is named in a body.
TABLE_REF = r"_\[(.+?) \(extracted to CSV\)\]\(tables/(table-[0-9]+\.csv)\)_"


def chunk_units(sections: DataFrame, doc: str, target: int = TARGET, merge: bool = True) -> DataFrame:
    """sections(doc, seq, section_id, title, path, text, searchable) -> units (doc, section_id, title, path, text, members).

    Searchable sections are units. With merge, neighbours of one non-empty path, each below target, are one unit as long
    as their texts stay within target together; it is named by its first. A document's sections are folded in order, within
    one row; a section that is not searchable ends a unit."""
    kind = "struct<section_id:string,title:string,path:string,text:string,size:int,members:array<string>,open:boolean>"
    order = F.array_sort(F.collect_list(F.struct("seq", F.col("section_id").cast("string").alias("section_id"), "title", F.coalesce("path", F.lit("")).alias("path"), F.coalesce("text", F.lit("")).alias("text"), "searchable")))

    def step(units: Column, s: Column) -> Column:
        last = F.element_at(units, -1)
        small = F.lit(merge) & (s["path"] != "") & (F.length(s["text"]) < target)
        joins = (F.size(units) > 0) & small & last["open"] & (last["path"] == s["path"]) & (last["size"] + F.length(s["text"]) <= target)
        fresh = F.struct(s["section_id"].alias("section_id"), s["title"].alias("title"), s["path"].alias("path"), s["text"].alias("text"), F.length(s["text"]).alias("size"), F.array(s["section_id"]).alias("members"), small.alias("open"))
        grown = F.struct(last["section_id"].alias("section_id"), last["title"].alias("title"), last["path"].alias("path"), F.concat(last["text"], F.lit("\n\n"), s["text"]).alias("text"), (last["size"] + F.length(s["text"])).alias("size"), F.concat(last["members"], F.array(s["section_id"])).alias("members"), F.lit(True).alias("open"))
        closed = F.transform(units, lambda u: u.withField("open", F.lit(False)))
        added = F.when(joins, F.concat(F.slice(units, F.lit(1), F.size(units) - 1), F.array(grown).cast(f"array<{kind}>"))).otherwise(F.concat(units, F.array(fresh).cast(f"array<{kind}>")))
        return F.when(F.coalesce(s["searchable"], F.lit(False)), added).otherwise(closed)

    folded = sections.groupBy(doc).agg(order.alias("s")).select(doc, F.aggregate("s", F.array().cast(f"array<{kind}>"), step).alias("units"))
    return folded.select(doc, F.explode("units").alias("u")).select(doc, "u.section_id", "u.title", "u.path", "u.text", "u.members")


def chunk_ids(parts: DataFrame, unit: str, part: str) -> Column:
    """The unit's own name for its first part, then with #p2, #p3 and so on."""
    return F.when(F.col(part) == 0, F.col(unit).cast("string")).otherwise(F.concat(F.col(unit).cast("string"), F.lit("#p"), (F.col(part) + 1).cast("string")))


def chunks_for_units(units: DataFrame, unit: str = "section_id", text: str = "text", target: int = TARGET, hard: int = HARD) -> DataFrame:
    """units with chunk_id and chunk: a unit's text, cut where it is oversized."""
    from quarry.operators.normalize import split_oversized
    from quarry.session import ship

    ship(units.sparkSession)

    @F.pandas_udf("array<string>")
    def cut(texts):
        return texts.map(lambda t: split_oversized(t or "", target, hard))

    each = units.select(*[c for c in units.columns if c != text], F.posexplode(cut(F.col(text))).alias("part", "chunk"))
    return each.withColumn("chunk_id", chunk_ids(each, unit, "part"))


def folded_title(app_name: Column, title: Column) -> Column:
    """The title with its application's name in front, unless that is empty or already in it."""
    app = F.trim(F.coalesce(app_name, F.lit("")))
    return F.when((app == "") | F.contains(F.lower(title), F.lower(app)), title).otherwise(F.concat(app, F.lit(" "), title))


def table_refs(text: Column) -> Column:
    """(name, caption) of the tables that a body names, in order."""
    captions, names = (F.regexp_extract_all(text, F.lit(TABLE_REF), F.lit(i)) for i in (1, 2))
    return F.zip_with(names, captions, lambda n, c: F.struct(n.alias("name"), c.alias("caption")))


def _table_lines(rows: Column) -> Column:
    """Rows as lines of cells, blank ones left out."""
    joined = F.transform(rows, lambda r: F.struct(F.array_join(F.transform(r, lambda c: F.trim(c)), " | ").alias("line"), F.exists(r, lambda c: F.trim(c) != "").alias("some")))
    return F.transform(F.filter(joined, lambda x: x["some"]), lambda x: x["line"])


def table_text(caption: Column, rows: Column) -> Column:
    """A table as text: its caption and its rows."""
    head = F.filter(F.array(F.trim(F.coalesce(caption, F.lit("")))), lambda c: c != "")
    return F.array_join(F.concat(head, _table_lines(rows)), "\n")


def table_windows(caption: Column, rows: Column, target: int = TARGET, hard: int = HARD) -> Column:
    """A table's texts: whole up to hard characters, else windows of rows of about target, each under the caption."""
    head = F.trim(F.coalesce(caption, F.lit("")))
    base = F.when(head == "", 0).otherwise(F.length(head) + 1)
    under = lambda w: F.array_join(F.concat(F.filter(F.array(head), lambda c: c != ""), w), "\n")

    def step(acc: Column, line: Column) -> Column:
        now = F.element_at(acc, -1)
        full = (F.size(now["lines"]) > 0) & (now["size"] + F.length(line) + 1 > target)
        alone = F.struct(F.array(line).alias("lines"), (base + F.length(line) + 1).alias("size"))
        grown = F.struct(F.concat(now["lines"], F.array(line)).alias("lines"), (now["size"] + F.length(line) + 1).alias("size"))
        return F.when(full, F.concat(acc, F.array(alone))).otherwise(F.concat(F.slice(acc, F.lit(1), F.size(acc) - 1), F.array(grown)))

    start = F.array(F.struct(F.array().cast("array<string>").alias("lines"), base.alias("size")))
    windows = F.transform(F.aggregate(_table_lines(rows), start, step), lambda w: under(w["lines"]))
    whole = table_text(caption, rows)
    return F.when(whole == "", F.array().cast("array<string>")).when(F.length(whole) <= hard, F.array(whole)).otherwise(windows)


def document_profile(bodies: DataFrame) -> DataFrame:
    """bodies(doc_key, body) -> eleven counts of a body; what stands in a code fence is neither heading nor table."""
    opened = F.col("line").rlike(r"^\s*(```+|~~~+)")
    each = lines(bodies).withColumn("fence", opened)
    pipe = ~F.col("fenced") & ~F.col("fence") & F.col("line").rlike(r"^\s*\|.*\|\s*$")
    before = F.lag(pipe, 1, False).over(Window.partitionBy("doc_key").orderBy("pos"))
    level = F.when(~F.col("fenced") & ~F.col("fence"), F.length(F.regexp_extract("line", r"^(#{1,6})\s+\S", 1))).otherwise(0)
    marked = each.select("doc_key", "line", "fenced", "fence", level.alias("level"), (pipe & ~before).alias("table_begins"))
    by_line = marked.groupBy("doc_key").agg(
        F.count_if(F.col("level") > 0).alias("headings"),
        F.countDistinct(F.when(F.col("level") > 0, F.col("level"))).alias("heading_levels"),
        F.max("level").cast("long").alias("heading_depth"),
        F.count_if(F.col("fence") & ~F.col("fenced")).alias("code_blocks"),
        F.count_if(F.col("fenced") & ~F.col("fence")).alias("code_lines"),
        F.count_if(F.col("table_begins")).alias("tables_gfm"),
    )
    times = lambda pattern: F.regexp_count("body", F.lit(pattern)).cast("long")
    whole = bodies.select(
        "doc_key",
        times(r"\S+").alias("words"),
        times(r"(?i)<table\b").alias("tables_html"),
        (times(r"!\[[^\]]*\]\([^)]*\)") + times(r"(?i)<img\b")).alias("images"),
        times(r"\[[^\]]*\]\(#[^)]*\)").alias("internal_links"),
        times(r"\^%?[A-Z][A-Z0-9]{1,7}\b|\$\$[A-Z0-9]+\^").alias("code_refs"),
    )
    return whole.join(by_line, "doc_key")
