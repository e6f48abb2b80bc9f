"""Table functions for SQL: scans of one page or body as rows, usable under the guarded entry."""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

from pyspark.sql import SparkSession
from pyspark.sql.functions import udtf

from quarry.operators.bodies import headings
from quarry.session import ship

_LINK = re.compile(r'(?is)<a href="([^"]*)">([^<]*)</a>')
_ROW, _CELL = re.compile(r"(?is)<tr\b[^>]*>(.*?)</tr>"), re.compile(r"(?is)<t[dh]\b[^>]*>(.*?)</t[dh]>")


class PageLinks:
    """page_links(html): the first link of each target, with its position among all links."""

    def eval(self, page: str) -> Iterator[tuple[int, str, str]]:
        seen = set()
        for pos, m in enumerate(_LINK.finditer(page or "")):
            if m[1] not in seen:
                seen.add(m[1])
                yield pos, m[1], m[2]


class BodySections:
    """body_sections(body): headings in order with level, title and slug."""

    def eval(self, body: str) -> Iterator[tuple[int, int, str, str]]:
        for n, h in enumerate(headings(body or ""), 1):
            yield n, h.level, h.text, h.slug


class TableRows:
    """table_rows(html): the cells of every table row, texts without tags."""

    def eval(self, page: str) -> Iterator[tuple[int, list[str]]]:
        for n, m in enumerate(_ROW.finditer(page or ""), 1):
            yield n, [html.unescape(re.sub(r"<[^>]+>", "", c)).strip() for c in _CELL.findall(m[1])]


FUNCTIONS = {
    "page_links": (PageLinks, "pos: bigint, target: string, label: string"),
    "body_sections": (BodySections, "seq: int, level: int, title: string, slug: string"),
    "table_rows": (TableRows, "seq: int, cells: array<string>"),
}


def register(spark: SparkSession) -> list[str]:
    """Make the table functions known to the session's SQL."""
    ship(spark)
    for name, (handler, schema) in FUNCTIONS.items():
        spark.udtf.register(name, udtf(handler, returnType=schema))
    return sorted(FUNCTIONS)
