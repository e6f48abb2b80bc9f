"""Scalar text functions as Column expressions (code-generated; no Python on the executors)."""

from __future__ import annotations

import re
from html.entities import name2codepoint

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Month names in order; each may also be cut to its first three letters, September to four.
MONTHS = ["january", "february", "march", "april", "may", "june", "july", "august", "september", "october", "november", "december"]
_MONTH_YEAR = r"(?i)\b(" + "|".join(f"{m[:3]}(?:{'t(?:ember)?' if m == 'september' else m[3:]})?" for m in MONTHS) + r")\.?,?\s+([0-9]{4})\b"


def block_key(c: Column) -> Column:
    """Lower-cased text with runs of white space as one space, trimmed."""
    return F.trim(F.regexp_replace(F.lower(c), r"[ \t\n\r\x0B\f]+", " "))


def slugify(c: Column, sep: str = "-", fallback: str = "") -> Column:
    """Lower case without white space around; keeps letters, digits, underscore, hyphen and space; spaces become sep."""
    bare = F.regexp_replace(F.lower(c), r"^[ \t\n\r\x0B\f]+|[ \t\n\r\x0B\f]+$", "")
    s = F.regexp_replace(F.regexp_replace(bare, r"[^\p{L}\p{N}_\- ]", ""), " ", sep)
    return F.when(s == "", F.lit(fallback)).otherwise(s)


def safe_component(c: Column) -> Column:
    """A name that is safe in a path: other runs of characters become one underscore."""
    s = F.regexp_replace(F.regexp_replace(c, r"[^A-Za-z0-9._-]+", "_"), r"^_+|_+$", "")
    return F.when(s == "", F.lit("_")).otherwise(s)


def doc_slug(filename: Column) -> Column:
    """The stem of a file name, lower case, other runs of characters as underscore."""
    stem = F.regexp_replace(F.regexp_extract(filename, r"([^/]*)$", 1), r"\.[A-Za-z0-9]+$", "")
    return F.regexp_replace(F.regexp_replace(F.lower(stem), r"[^a-z0-9]+", "_"), r"^_+|_+$", "")


def word_count(c: Column) -> Column:
    return F.regexp_count(c, F.lit(r"[^ \t\n\r\x0B\f]+")).cast("long")


def scrub_control(c: Column) -> Column:
    return F.regexp_replace(c, r"[\x00-\x08\x0B\x0C\x0E-\x1F\x7F]", "")


def strip_tags(c: Column) -> Column:
    return F.regexp_replace(c, r"<[^>]+>", "")


def unescape(c: Column) -> Column:
    """One level of character references that end with a semicolon: all numbers, and the names of HTML 4."""
    names = F.create_map(*[F.lit(x) for name, code in sorted(name2codepoint.items()) for x in (name, chr(code))])

    def one(part: Column) -> Column:
        ref = F.regexp_extract(part, r"^(#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6}|[A-Za-z][A-Za-z0-9]{1,30});", 1)
        code = F.when(ref.rlike("^#[xX]"), F.conv(F.substr(ref, F.lit(3)), 16, 10)).when(F.startswith(ref, F.lit("#")), F.substr(ref, F.lit(2))).try_cast("int")
        sound = (code > 0) & (code < 0x110000) & ~code.between(0xD800, 0xDFFF)
        got = F.coalesce(F.when(sound, F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")), F.when(ref != "", names[ref]))
        return F.when(got.isNull(), F.concat(F.lit("&"), part)).otherwise(F.concat(got, F.substr(part, F.length(ref) + 2)))

    parts = F.split(c, "&", -1)
    return F.when(F.contains(c, F.lit("&")), F.concat(parts[0], F.array_join(F.transform(F.slice(parts, F.lit(2), F.size(parts)), one), ""))).otherwise(c)


def strip_html(c: Column) -> Column:
    return F.trim(F.regexp_replace(unescape(strip_tags(c)), r"[ \t]+", " "))


def month_year(c: Column) -> Column:
    """YYYY-MM of the first month name or its short form and year ("Sept. 2018", "Mar, 2018"), else null."""
    month, year = F.lower(F.substring(F.regexp_extract(c, _MONTH_YEAR, 1), 1, 3)), F.regexp_extract(c, _MONTH_YEAR, 2)
    number = F.array_position(F.array(*[F.lit(m[:3]) for m in MONTHS]), month)
    return F.when(year != "", F.concat(year, F.lit("-"), F.lpad(number.cast("string"), 2, "0")))


def decade(c: Column) -> Column:
    """The decade of the first month and year, like 2010s, else unknown."""
    year = F.substring(month_year(c), 1, 3)
    return F.coalesce(F.concat(year, F.lit("0s")), F.lit("unknown"))


def heading_text(c: Column) -> Column:
    """A heading or quoted line without its marks in front and stars or colons behind."""
    return F.trim(F.regexp_replace(F.regexp_replace(c, r"^[>#* ]+", ""), r"[*: ]+$", ""))


def url_host(c: Column) -> Column:
    return F.lower(F.regexp_extract(c, r"^[a-zA-Z]+://([^/?#]+)", 1))


def url_extension(c: Column) -> Column:
    """Extension of the last path segment, lower case, without dot; empty if there is none."""
    path = F.regexp_replace(F.regexp_replace(c, r"[?#].*$", ""), r"^[a-zA-Z]+://[^/]*", "")
    return F.lower(F.regexp_extract(path, r"\.([A-Za-z0-9]+)$", 1))


def version_parts(c: Column) -> Column:
    """(major, minor) of a dotted version; empty strings where it is none."""
    ok = c.rlike(r"^[0-9]+\.[0-9]+$")
    parts = F.split(c, r"\.")
    return F.struct(F.when(ok, parts[0]).otherwise("").alias("major"), F.when(ok, parts[1]).otherwise("").alias("minor"))


def third_number(c: Column, sep: str = "*") -> Column:
    """The third part of an id like A*1*23 as a number, else null."""
    return F.try_element_at(F.split(c, r"\*"), F.lit(3)).try_cast("int")


def is_distinctive(c: Column) -> Column:
    """Worth finding in running text: has a digit, begins with a caret, or has several words."""
    return c.rlike(r"[0-9]") | c.startswith("^") | c.rlike(r"\S\s+\S")


def normal_surface(c: Column) -> Column:
    return F.upper(F.trim(F.regexp_replace(c, r"\s+", " ")))


def pipe_cells(c: Column) -> Column:
    """Cells of a table line split at pipes that no backslash precedes, without the empty ones at its ends."""
    line = F.regexp_replace(F.trim(c), r"^\||(?<!\\)\|$", "")
    return F.transform(F.split(line, r"(?<!\\)\|"), lambda x: F.trim(F.replace(x, F.lit("\\|"), F.lit("|"))))


def html_cells(row: Column) -> Column:
    """Texts of the cells of one row of an HTML table."""
    return F.transform(F.regexp_extract_all(row, F.lit(r"(?is)<t[dh][^>]*>(.*?)</t[dh]>"), F.lit(1)), strip_html)


def html_rows(c: Column) -> Column:
    """Rows of an HTML table as arrays of cell texts."""
    return F.transform(F.regexp_extract_all(c, F.lit(r"(?is)<tr[^>]*>(.*?)</tr>"), F.lit(1)), html_cells)


def gfm_table(rows: Column) -> Column:
    """Rows of cells as a markdown table: all as wide as the first, pipes escaped."""
    width = F.size(rows[0])
    cells = lambda r: F.transform(F.sequence(F.lit(0), width - 1), lambda i: F.regexp_replace(F.coalesce(F.get(r, i), F.lit("")), r"\|", r"\\|"))
    line = lambda r: F.concat(F.lit("| "), F.array_join(cells(r), " | "), F.lit(" |"))
    rule = F.concat(F.lit("| "), F.array_join(F.array_repeat(F.lit("---"), width), " | "), F.lit(" |"))
    return F.array_join(F.concat(F.array(line(rows[0]), rule), F.transform(F.slice(rows, F.lit(2), F.size(rows)), line)), "\n")


def strip_numbering(c: Column) -> Column:
    return F.regexp_replace(c, r"^[0-9]+(\.[0-9]+)*\.? +", "")


def md_link_text(c: Column) -> Column:
    return F.regexp_replace(c, r"\[([^\]]*)\]\([^)]*\)", "$1")


def acronyms(c: Column) -> Column:
    """Distinct whole words of 2 to 8 capitals and digits that begin with a capital, first seen first."""
    words = F.regexp_extract_all(c, F.lit(r"([\p{L}\p{N}_]+)"), F.lit(1))
    return F.array_distinct(F.filter(words, lambda w: w.rlike("^[A-Z][A-Z0-9]{1,7}$")))


def image_targets(c: Column) -> Column:
    """Distinct base names of image targets, first seen first."""
    return F.array_distinct(F.transform(F.regexp_extract_all(c, F.lit(r"!\[[^\]]*\]\(([^)\s]+)\)"), F.lit(1)), lambda x: F.regexp_extract(x, r"([^/]*)$", 1)))


def first_keyword(c: Column, roles: list[tuple[str, str]]) -> Column:
    """The role of the first keyword, in the given order, that the text contains."""
    out = F.lit(None).cast("string")
    for word, role in reversed(roles):
        out = F.when(F.contains(F.lower(c), F.lit(word)), F.lit(role)).otherwise(out)
    return out


def patch_identity(c: Column) -> Column:
    """(package, version, number, several) of the first patch id like AB*5.3*12 in a title; several where more packages share one."""
    pattern = r"\b([A-Z][A-Z0-9]+)\*([0-9.]+)\*([0-9]+)"
    package = F.nullif(F.regexp_extract(c, pattern, 1), F.lit(""))
    return F.struct(package.alias("package"), F.nullif(F.regexp_extract(c, pattern, 2), F.lit("")).alias("version"), F.regexp_extract(c, pattern, 3).try_cast("int").alias("number"), c.rlike(r"\b[A-Z][A-Z0-9]+\*[0-9.]+\*[0-9]+/[A-Z][A-Z0-9]+\*").alias("several"))


def without_versions(c: Column) -> Column:
    """A title without patch ids, version and release numbers."""
    bare = F.regexp_replace(c, r"\b[A-Z][A-Z0-9]+\*[0-9.]+\*[0-9]+(/[A-Z][A-Z0-9]+\*[0-9.]+\*[0-9]+)*", "")
    bare = F.regexp_replace(bare, r"(?i)\b(version|ver\.?|v\.?|release|rel\.?|patch|build|rev\.?)\s*[0-9]+(\.[0-9]+)*\b", "")
    return F.trim(F.regexp_replace(F.regexp_replace(bare, r"\s+", " "), r"^[\s,;:\-–—]+|[\s,;:\-–—]+$", ""))


def corrected(c: Column, corrections: list[tuple[str, str]]) -> Column:
    """(text, aliases): replacements in the given order, and the misspellings that were found."""
    text, found = c, []
    for wrong, right in corrections:
        found.append(F.when(F.contains(text, F.lit(wrong)), F.lit(wrong)))
        text = F.replace(text, F.lit(wrong), F.lit(right))
    return F.struct(text.alias("text"), F.filter(F.array(*found), lambda x: x.isNotNull()).alias("aliases"))


def bounded_pattern(surface: str) -> str:
    """A pattern of a surface that no letter or digit continues at an end that is one itself."""
    left, right = (r"(?<![A-Za-z0-9])" if surface[:1].isalnum() else "", r"(?![A-Za-z0-9])" if surface[-1:].isalnum() else "")
    return left + re.escape(surface) + right
