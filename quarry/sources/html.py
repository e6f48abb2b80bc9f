"""Scans of HTML pages: links, titles and paragraphs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.functions.text import strip_html, url_host


def links(pages: DataFrame) -> DataFrame:
    """(page_id, pos, target, label): the first link of each target on a page."""
    found = F.regexp_extract_all("html", F.lit(r'(?is)<a href="([^"]*)">([^<]*)</a>'), F.lit(1))
    labels = F.regexp_extract_all("html", F.lit(r'(?is)<a href="([^"]*)">([^<]*)</a>'), F.lit(2))
    each = pages.select("page_id", F.posexplode(F.arrays_zip(found.alias("target"), labels.alias("label"))).alias("pos", "x"))
    return each.groupBy("page_id", F.col("x.target").alias("target")).agg(F.min("pos").cast("long").alias("pos"), F.min_by("x.label", "pos").alias("label"))


def parts(pages: DataFrame) -> DataFrame:
    """(page_id, host, title, heading, paragraphs): text of title, first h1 and the number of paragraphs."""
    one = lambda tag: strip_html(F.regexp_extract("html", rf"(?is)<{tag}[^>]*>(.*?)</{tag}>", 1))
    return pages.select("page_id", url_host(F.col("url")).alias("host"), one("title").alias("title"), one("h1").alias("heading"), F.regexp_count("html", F.lit(r"(?i)<p>")).cast("long").alias("paragraphs"))


def to_markdown(pages: DataFrame) -> DataFrame:
    """(page_id, body): headings, paragraphs and list items of a page as markdown; scripts, styles and comments go."""
    body = F.regexp_replace("html", r"(?is)<(script|style)[^>]*>.*?</(script|style)>|<!--.*?-->", "")
    body = F.regexp_replace(body, r"(?is)<h1[^>]*>(.*?)</h1>", "\n# $1\n")
    body = F.regexp_replace(body, r"(?i)<li>", "\n- ")
    body = F.regexp_replace(body, r"(?i)</?p>|<br>", "\n")
    return pages.select("page_id", F.trim(F.regexp_replace(strip_html(body), r"\n[ \n]*\n", "\n\n")).alias("body"))
