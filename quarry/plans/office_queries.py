"""Word-processor files made of the test tables, read back as markdown, with SQL of what must come out."""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import lru_cache
from struct import pack
from xml.sax.saxutils import escape

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.plans.register import registry
from quarry.session import ship, table
from quarry.sources import office

QUERIES, ORACLES, query = registry()

_NS = 'xmlns:w="http://schemas.openxmlformats.org/wordprocessingml/2006/main" xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships" xmlns:a="http://schemas.openxmlformats.org/drawingml/2006/main"'
_STYLES = f"""<w:styles {_NS}><w:style w:styleId="T"><w:name w:val="Title"/></w:style><w:style w:styleId="H2"><w:name w:val="heading 2"/></w:style>
<w:style w:styleId="Own"><w:name w:val="Own heading"/><w:basedOn w:val="H2"/></w:style><w:style w:styleId="C"><w:name w:val="Source Code"/></w:style></w:styles>"""
_NUMBERS = f"""<w:numbering {_NS}><w:abstractNum w:abstractNumId="0"><w:lvl w:ilvl="0"><w:start w:val="1"/><w:numFmt w:val="decimal"/></w:lvl><w:lvl w:ilvl="1"><w:numFmt w:val="bullet"/></w:lvl></w:abstractNum>
<w:num w:numId="3"><w:abstractNumId w:val="0"/></w:num></w:numbering>"""
_RELS = """<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships"><Relationship Id="p1" Target="media/seal.png"/><Relationship Id="u1" Target="http://x.test/a"/></Relationships>"""


@lru_cache(8192)
def paragraph(text: str, style: str = "", number: str = "", bookmark: str = "", raw: bool = False) -> str:
    inner = text if raw else f'<w:r><w:t xml:space="preserve">{escape(text)}</w:t></w:r>'
    props = (f'<w:pStyle w:val="{style}"/>' if style else "") + (f'<w:numPr><w:ilvl w:val="{number[1]}"/><w:numId w:val="{number[0]}"/></w:numPr>' if number else "")
    mark = f'<w:bookmarkStart w:id="1" w:name="{bookmark}"/><w:bookmarkEnd w:id="1"/>' if bookmark else ""
    return f"<w:p>{f'<w:pPr>{props}</w:pPr>' if props else ''}{mark}{inner}</w:p>"


_SAME = ("word/styles.xml", "word/numbering.xml", "word/_rels/document.xml.rels")


@lru_cache(64)
def _part(name: str, content: str | bytes) -> tuple[bytes, bytes, bytes]:
    """A part with its header, and its entry in the directory before and behind the part's place."""
    named, raw = name.encode(), content.encode() if isinstance(content, str) else content
    deflated = name == "word/document.xml" or len(content) > 4096
    put = raw
    if deflated:
        deflate = zlib.compressobj(zlib.Z_DEFAULT_COMPRESSION, zlib.DEFLATED, -15)
        put = deflate.compress(raw) + deflate.flush()
    # Version 2.0, made on Unix, of 1 January 1980, to be read and written by its owner.
    facts = pack("<4H3L2H", 0, 8 if deflated else 0, 0, 33, zlib.crc32(raw), len(put), len(raw), len(named), 0)
    return b"PK\3\4\x14\0%b%b%b" % (facts, named, put), b"PK\1\2\x14\3\x14\0%b%b" % (facts, pack("<3HL", 0, 0, 0, 0o600 << 16)), named


def packed(body: str, media: dict[str, bytes] | None = None) -> bytes:
    """A file of the format around the XML of a body; the same bytes for the same parts. The body is deflated, small parts are stored."""
    parts = {"word/document.xml": f"<w:document {_NS}><w:body>{body}</w:body></w:document>", "word/styles.xml": _STYLES, "word/numbering.xml": _NUMBERS, "word/_rels/document.xml.rels": _RELS, **(media or {})}
    out, entries, at = [], [], 0
    for name, content in parts.items():
        local, entry, named = (_part if name in _SAME else _part.__wrapped__)(name, content)
        out.append(local)
        entries += [entry, pack("<L", at), named]
        at += len(local)
    return b"".join([*out, *entries, pack("<4s4H2LH", b"PK\5\6", 0, 0, len(parts), len(parts), sum(map(len, entries)), at, 0)])


def order_file(order: int, priority: str, lines: list[tuple[int, str, str]]) -> bytes:
    """Of every seventh order a damaged file."""
    rows = "".join("<w:tr>" + "".join(f"<w:tc>{paragraph(str(c))}</w:tc>" for c in r) + "</w:tr>" for r in [("No", "Flag", "Day"), *lines])
    bold = '<w:r><w:rPr><w:b/></w:rPr><w:t>Prio</w:t></w:r><w:r><w:rPr><w:b/></w:rPr><w:t xml:space="preserve">rity: </w:t></w:r>'
    link = '<w:hyperlink w:anchor="_Toc7"><w:r><w:t>lines</w:t></w:r></w:hyperlink><w:del><w:r><w:delText>gone</w:delText></w:r></w:del><w:r><w:t xml:space="preserve"> | </w:t></w:r><w:hyperlink r:id="u1"><w:r><w:t>out</w:t></w:r></w:hyperlink>'
    body = paragraph(f"Order {order}", "T") + paragraph(f"{bold}<w:r><w:t>{escape(priority)} &amp; so on</w:t></w:r>", raw=True) + paragraph(link, raw=True)
    body += paragraph("Lines", "Own", bookmark="_Toc7") + f"<w:tbl>{rows}</w:tbl>" + "".join(paragraph(f"line {n}", number="30") + paragraph(f"flag {f}", number="31") for n, f, _ in lines)
    body += paragraph('<w:r><w:drawing><a:blip r:embed="p1"/></w:drawing></w:r>', raw=True) + paragraph("x := 1", "C") + paragraph("  y := 2", "C")
    whole = packed(body, {"word/media/seal.png": b"seal %d" % order})
    return whole[: len(whole) // 2] if order % 7 == 0 else whole


@query(r"""WITH l AS (SELECT DISTINCT l_orderkey, l_linenumber AS n, l_returnflag AS f, strftime(l_shipdate, '%Y-%m-%d') AS day FROM lineitem),
t AS (SELECT l_orderkey, string_agg('| ' || n || ' | ' || f || ' | ' || day || ' |', chr(10) ORDER BY n, f, day) AS rows, list({'n': n, 'f': f} ORDER BY n, f, day) AS items FROM l GROUP BY l_orderkey),
b AS (SELECT o_orderkey, '# Order ' || o_orderkey || chr(10) || chr(10) || '**Priority:** ' || o_orderpriority || ' & so on' || chr(10) || chr(10) || '[lines](#_Toc7) | [out](http://x.test/a)' || chr(10) || chr(10) || '<span id="_Toc7"></span>' || chr(10) || '## Lines' || chr(10) || chr(10)
  || '| No | Flag | Day |' || chr(10) || '|---|---|---|' || chr(10) || rows || chr(10) || chr(10) || array_to_string(list_transform(range(1, len(items) + 1), lambda i: i || '. line ' || items[i].n || chr(10) || '    - flag ' || items[i].f), chr(10))
  || chr(10) || chr(10) || '![](media/seal.png)' || chr(10) || chr(10) || '```' || chr(10) || 'x := 1' || chr(10) || '  y := 2' || chr(10) || '```' || chr(10) AS body FROM orders JOIN t ON l_orderkey = o_orderkey)
SELECT o_orderkey || '.docx' AS path, CASE WHEN o_orderkey % 7 <> 0 THEN md5(body) END AS body, CASE WHEN o_orderkey % 7 <> 0 THEN 'seal.png ' || sha256('seal ' || o_orderkey) ELSE '' END AS pictures, o_orderkey % 7 = 0 AS damaged FROM b""")
def office_bodies(spark: SparkSession, d: str) -> DataFrame:
    """A file of each order, read back: title, bold text, links, bookmarked heading, table, nested list, picture and code."""
    ship(spark)
    line = F.struct("l_linenumber", "l_returnflag", F.date_format("l_shipdate", "yyyy-MM-dd").alias("day"))
    lines = table(spark, d, "lineitem").groupBy("l_orderkey").agg(F.sort_array(F.collect_set(line)).alias("lines"))
    orders = table(spark, d, "orders").join(lines, F.col("o_orderkey") == F.col("l_orderkey")).select("o_orderkey", "o_orderpriority", "lines")

    def listed(x: pa.Array) -> list:
        return x.to_pylist() if x.null_count else x.to_numpy(zero_copy_only=False).tolist()

    def write(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            held = part.column("lines")
            rows = list(zip(*map(listed, held.flatten().flatten()), strict=True))
            ends = [0, *held.value_lengths().to_numpy().cumsum().tolist()]
            keys, priorities = (listed(part.column(c)) for c in ("o_orderkey", "o_orderpriority"))
            content = [order_file(order, priority, rows[a:b]) for order, priority, a, b in zip(keys, priorities, ends[:-1], ends[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array([f"{key}.docx" for key in keys], pa.string()), pa.array(content, pa.binary())], names=["path", "content"])

    found = office.to_markdown(orders.mapInArrow(write, "path string, content binary"))
    pictures = F.array_join(F.transform("pictures", lambda p: F.concat_ws(" ", p["name"], p["sha256"])), ",")
    return found.select("path", F.md5("body").alias("body"), pictures.alias("pictures"), F.col("error").isNotNull().alias("damaged"))
