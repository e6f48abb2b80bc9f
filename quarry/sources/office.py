"""Word-processor files to markdown on the executors: the zipped XML is read as it is, no converter is called.

Styles give headings (by outline level, or by the names Title and Heading n, through the styles they are based on), numbering gives
lists with their depth and count, tables become pipe tables, bookmarks spans in front of their paragraph, links to
bookmarks or addresses links, pictures references to their names at their place, and paragraphs of a code style
fences. Deleted text is left out, inserted text kept.

Files come as rows (path, content), as binaryFile reads them. A file that is damaged, too large when unpacked, or no such file at
all gives a row with its error, no body and no pictures; null content is an error too. Text is not escaped, but
for pipes in cells.
"""

from __future__ import annotations

import hashlib
import io
import posixpath
import re
import zipfile
import zlib
from collections.abc import Callable, Iterator
from functools import lru_cache
from struct import Struct
from xml.etree import ElementTree

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.session import ship

#: Namespaces of the format.
W = "{http://schemas.openxmlformats.org/wordprocessingml/2006/main}"
R = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}"
A = "{http://schemas.openxmlformats.org/drawingml/2006/main}"
V = "{urn:schemas-microsoft-com:vml}"
P, R_, T, TBL, TR, TC, PPR, RPR = (W + x for x in ("p", "r", "t", "tbl", "tr", "tc", "pPr", "rPr"))
STYLE, OUTLINE, NUMBER, NUMBER_ID, DEPTH = (W + x for x in ("pStyle", "outlineLvl", "numPr", "numId", "ilvl"))
FIELD, TOLD, BOOKMARK, NAME, VAL = (W + x for x in ("fldChar", "instrText", "bookmarkStart", "name", "val"))
#: A mark that stands for a paragraph; the begin of a main part, and the start tag of a paragraph with attributes that does not end there.
PLACE = W + "place"
_BEGIN = re.compile(rb"(?:\xef\xbb\xbf)?(?:<\?xml version=[\"']1\.0[\"'](?: encoding=[\"'](?:UTF|utf)-8[\"'])?(?: standalone=[\"'](?:yes|no)[\"'])?\s*\?>\s*)?(<w:document(?:\s[^<>]*)?>)\s*<w:body>")
_OPEN = re.compile(rb"<w:p\s[^<>]*(?<!/)>")
WRAPS = frozenset(W + x for x in ("sdt", "sdtContent", "ins", "customXml", "smartTag"))
#: Parts that many files share (styles, numbering, relations) are read once: so many, of at most so many bytes.
SHARED, SHARED_BYTES = 64, 1 << 18
#: Kinds of files (of the same declarations, styles and relations) whose paragraphs are kept as they were read; for each kind so many paragraphs and
#: layouts without them, of at most so many bytes each.
KINDS, KEPT, KEPT_BYTES, LAYOUTS, LAYOUT_BYTES = 8, 8192, 512, 64, 8192
#: Bytes that one part of a file may take when unpacked, and all its pictures.
MOST_PART, MOST_MEDIA = 200_000_000, 500_000_000
SCHEMA = "path string, body string, pictures array<struct<name:string,target:string,place:int,size:long,sha256:string>>, error string"


_END, _ENTRY, _LOCAL = Struct("<4s4H2LH"), Struct("<4s4B4HL2L5H2L"), Struct("<4s2B4HL2L2H")


#: A part's name, method, check sum, bytes as they lie there and when unpacked, and where its header begins and the next one does.
Entry = tuple[bytes, int, int, int, int, int, int]


def _directory(content: bytes) -> dict[str, Entry] | None:
    """The parts of a plainly built file; None of any other, which zipfile reads or rejects."""
    end = len(content) - _END.size
    if end < 0:
        return None
    mark, disk, first, here, count, size, at, comment = _END.unpack_from(content, end)
    if mark != b"PK\5\6" or disk or first or here != count or comment or at + size != end:
        return None
    rows, place = [], at
    for _ in range(count):
        if place + _ENTRY.size > end:
            return None
        mark, _, _, version, _, flags, method, _, _, crc, packed, whole, named, extra, said, disk, _, _, start = _ENTRY.unpack_from(content, place)
        place += _ENTRY.size
        name = content[place : place + named]
        place += named + said
        # Flags may name the deflater's effort, sizes behind the data, and UTF-8.
        if mark != b"PK\1\2" or version > 45 or flags & ~0x80E or method not in (0, 8) or extra or disk or max(packed, whole) >= 1 << 31 or b"\0" in name or not name.isascii():
            return None
        rows.append((name, method, crc, packed, whole, start))
    parts, stop = {}, at
    for row in reversed(rows):
        if row[5] >= stop:
            return None
        parts.setdefault(row[0].decode(), (*row, stop))
        stop = row[5]
    return parts if place == end else None


class Pack:
    """The parts of a zipped file. What is plainly built is read as it lies there; whatever looks odd goes through zipfile."""

    def __init__(self, content: bytes):
        self.content = content
        self.parts = _directory(content)
        self.whole = zipfile.ZipFile(io.BytesIO(content)) if self.parts is None else None

    def size(self, name: str) -> int | None:
        found = (self.whole.NameToInfo if self.parts is None else self.parts).get(name)
        return None if found is None else found.file_size if self.parts is None else found[4]

    def read(self, name: str) -> bytes:
        raw = None if self.parts is None else self._plain(self.parts[name])
        if raw is not None:
            return raw
        self.whole = self.whole or zipfile.ZipFile(io.BytesIO(self.content))
        return self.whole.read(name)

    def _plain(self, e: Entry) -> bytes | None:
        name, method, crc, packed, size, at, stop = e
        if at + _LOCAL.size > stop:
            return None
        mark, _, _, flags, told, _, _, _, _, _, named, extra = _LOCAL.unpack_from(self.content, at)
        begin = at + _LOCAL.size + named + extra
        if mark != b"PK\3\4" or flags & ~0x80E or told != method or self.content[at + _LOCAL.size : begin - extra] != name or begin + packed > stop:
            return None
        raw = self.content[begin : begin + packed]
        if method:
            unpack = zlib.decompressobj(-15)
            try:
                raw = unpack.decompress(raw, size + 1)
            except zlib.error:
                return None
            if not unpack.eof or unpack.unused_data:
                return None
        return raw if len(raw) == size and zlib.crc32(raw) == crc else None


def _raw(pack: Pack, name: str) -> bytes | None:
    size = pack.size(name)
    if size is None:
        return None
    if size > MOST_PART:
        raise ValueError(f"{name} is too large")
    raw = pack.read(name)
    if b"<!" in raw and (b"<!DOCTYPE" in raw[:4096] or b"<!ENTITY" in raw):
        raise ValueError(f"{name} declares entities")
    return raw


def _shared(read: Callable) -> Callable:
    """read(root of a part's XML, or None) as a function of the part's bytes; short parts are kept, and what was read is not changed."""

    def fresh(raw: bytes | None):
        return read(None if raw is None else ElementTree.fromstring(raw))

    kept = lru_cache(SHARED)(fresh)
    return lambda raw: (kept if raw is None or len(raw) <= SHARED_BYTES else fresh)(raw)


def _value(node: ElementTree.Element | None, path: str, name: str = "val") -> str | None:
    found = None if node is None else node.find(path)
    return None if found is None else found.get(W + name)


def _on(props: ElementTree.Element | None, tag: str) -> bool:
    found = None if props is None else props.find(W + tag)
    return found is not None and found.get(W + "val", "true") not in ("0", "false", "none")


class Styles:
    """What a paragraph style means: a heading's level, a list, or code; asked through the styles that it is based on."""

    def __init__(self, root: ElementTree.Element | None):
        self.by = {} if root is None else {s.get(W + "styleId"): s for s in root.iter(W + "style")}
        self._told: dict[str | None, tuple[bool, int, tuple[str | None, str | None]]] = {}

    def told(self, style: str | None) -> tuple[bool, int, tuple[str | None, str | None]]:
        """code(), level() and numbering() of a style that the file has, or of none."""
        if style not in self._told:
            if style not in self.by:
                return False, 0, (None, None)
            self._told[style] = (self.code(style), self.level(style), self.numbering(style))
        return self._told[style]

    def _chain(self, style: str | None) -> Iterator[ElementTree.Element]:
        seen: set[str] = set()
        while style in self.by and style not in seen:
            seen.add(style)
            yield self.by[style]
            style = _value(self.by[style], W + "basedOn")

    def level(self, style: str | None) -> int:
        """1 to 6 of a heading, else 0."""
        for s in self._chain(style):
            outline = _value(s, f"{W}pPr/{W}outlineLvl")
            if outline is not None and outline.isdigit():
                return min(6, int(outline) + 1) if int(outline) < 9 else 0
            name = (_value(s, W + "name") or "").lower()
            if name == "title":
                return 1
            if m := re.fullmatch(r"heading (\d)", name):
                return min(6, int(m[1]))
        return 0

    def code(self, style: str | None) -> bool:
        return any(re.search(r"\bcode\b|preformatted", (_value(s, W + "name") or "").lower()) for s in self._chain(style))

    def numbering(self, style: str | None) -> tuple[str | None, str | None]:
        for s in self._chain(style):
            number = _value(s, f"{W}pPr/{W}numPr/{W}numId")
            if number is not None:
                return number, _value(s, f"{W}pPr/{W}numPr/{W}ilvl")
        return None, None


class Formats:
    """Formats and first numbers of list levels."""

    def __init__(self, root: ElementTree.Element | None):
        self.formats: dict[tuple[str, int], str] = {}
        self.starts: dict[tuple[str, int], int] = {}
        if root is None:
            return
        abstract = {a.get(W + "abstractNumId"): a for a in root.iter(W + "abstractNum")}
        for num in root.iter(W + "num"):
            of = abstract.get(_value(num, W + "abstractNumId"))
            for lvl in () if of is None else of.iter(W + "lvl"):
                at = (num.get(W + "numId"), int(lvl.get(W + "ilvl", "0")))
                self.formats[at] = _value(lvl, W + "numFmt") or "bullet"
                self.starts[at] = int(_value(lvl, W + "start") or 1)
            for over in num.iter(W + "lvlOverride"):
                at = (num.get(W + "numId"), int(over.get(W + "ilvl", "0")))
                self.starts[at] = int(_value(over, W + "startOverride") or self.starts.get(at, 1))


class Numbering:
    """The running counts of a file's ordered lists."""

    def __init__(self, of: Formats):
        self.formats, self.starts = of.formats, of.starts
        self.counts: dict[tuple[str, int], int] = {}

    def mark(self, number: str, level: int) -> str:
        """The list mark of the next item of a level; deeper levels begin anew."""
        kind = self.formats.get((number, level), "bullet")
        if len(self.counts) > ((number, level) in self.counts):
            for at in [a for a in self.counts if a[0] == number and a[1] > level]:
                del self.counts[at]
        if kind in ("bullet", "none"):
            return "-"
        at = (number, level)
        self.counts[at] = self.counts.get(at, self.starts.get(at, 1) - 1) + 1
        return f"{self.counts[at]}."


def _targets(root: ElementTree.Element | None) -> dict[str | None, str]:
    return {} if root is None else {r.get("Id"): r.get("Target") or "" for r in root}


_styles, _formats, _relations = _shared(Styles), _shared(Formats), _shared(_targets)

Pictures = tuple[str, ...]
#: A paragraph below the body: its kind, its text, of an item its list and depth, and its pictures' targets; and one of a cell.
Block = tuple[str, str, tuple[str, int] | None, Pictures]
Cell = tuple[str, Pictures]


class Kept:
    """What was read of equal pieces: those used last, between KEPT and twice as many at most."""

    def __init__(self) -> None:
        self.new: dict[bytes, tuple] = {}
        self.old: dict[bytes, tuple] = {}

    def again(self, piece: bytes) -> tuple | None:
        """A piece that was not used since the last turn, if it is still there."""
        found = self.old.get(piece)
        if found is not None:
            self.put(piece, found)
        return found

    def put(self, piece: bytes, told: tuple) -> None:
        if len(piece) <= KEPT_BYTES:
            if len(self.new) >= KEPT:
                self.old, self.new = self.new, {}
            self.new[piece] = told


def _steps(parent: ElementTree.Element, tags: tuple[str, ...] = (P,)) -> Iterator:
    """What counts below a body, in order: paragraphs (of these tags), and tables as rows of cells (paragraphs, merged with the row above, columns more)."""
    for node in parent:
        tag = node.tag
        if tag in tags:
            yield node
        elif tag == TBL:
            yield [[_cell(tc, tags) for tc in tr.findall(TC)] for tr in node.findall(TR)]
        elif tag in WRAPS:
            yield from _steps(node, tags)


def _cell(tc: ElementTree.Element, tags: tuple[str, ...]) -> tuple[list, bool, int]:
    props = tc.find(W + "tcPr")
    merge = None if props is None else props.find(W + "vMerge")
    below = merge is not None and merge.get(W + "val", "continue") == "continue"
    return [p for p in tc.iter() if p.tag in tags], below, 0 if props is None else int(_value(props, W + "gridSpan") or 1) - 1


def _numbered(steps: Iterator, at: Callable[[ElementTree.Element, bool], int], below: bool = True) -> list:
    """Steps with numbers for paragraphs; a row of single paragraphs is a tuple of their numbers. Merged cells' paragraphs get numbers if ``below``."""
    out: list = []
    for step in steps:
        if not isinstance(step, list):
            out.append(at(step, False))
            continue
        rows: list = []
        for row in step:
            cells = [([at(p, True) for p in some] if below or not merged else [], merged, more) for some, merged, more in row]
            rows.append(tuple(some[0] for some, _, _ in cells) if all(len(some) == 1 and not merged and more < 1 for some, merged, more in cells) else cells)
        out.append(rows)
    return out


def _pieces(raw: bytes) -> tuple[bytes, bytes, list[bytes]] | None:
    """(start tag, body with marks in the paragraphs' places, paragraphs, those without attributes by what is in them) of a main part in which each
    "<" begins a tag and prefixes mean the same throughout; None of any other, of one with paragraphs in paragraphs, and perhaps of one that is not well-formed.

    A whole is well-formed if the body with its marks is, and each paragraph for itself: who takes it apart so has to read both."""
    m = _BEGIN.match(raw)
    if m is None or raw.find(b"<!") >= 0 or raw.find(b"<?", m.start(1)) >= 0 or raw.find(b"xmlns", m.end(1)) >= 0 or b"<w:place" in raw:
        return None
    if _OPEN.search(raw, m.end()) is None:
        first, *parts = raw[m.end() :].split(b"<w:p>")
        cut = [x.partition(b"</w:p>") for x in parts]
        if not all([c[1] for c in cut]):
            return None
        return m[1], b"<w:place/>".join([first, *[c[2] for c in cut]]), [c[0] for c in cut]
    *chunks, last = raw[m.end() :].split(b"</w:p>")
    between, pieces = [], []
    for chunk in chunks:
        at = chunk.find(b"<w:p>")
        if at < 0:
            opened = _OPEN.search(chunk)
            if opened is None:
                return None
            at = opened.start()
        between.append(chunk[:at])
        pieces.append(chunk[at:] + b"</w:p>")
    between.append(last)
    return m[1], b"<w:place/>".join(between), pieces


class Kind:
    """How paragraphs read in files of the same styles and relations. A paragraph's text follows from its XML alone; counts of lists do not."""

    def __init__(self, styles: Styles, targets: dict[str | None, str], head: bytes = b""):
        self.styles, self.targets, self.head = styles, targets, head
        self.pictures: list[str] = []
        self.blocks, self.cells = Kept(), Kept()
        self.layouts: dict[bytes, tuple[list, list[bool], list]] = {}

    def _layout(self, marked: bytes) -> tuple[list, list[bool], list]:
        """Steps with paragraphs as numbers, which of the marked ones are cells', and the others as read, which count behind them."""
        body = ElementTree.fromstring(self.head + b"<w:body>" + marked).find(W + "body")
        number = {node: k for k, node in enumerate(body.iter(PLACE))}
        in_cells: dict[int, bool] = {}
        others: list = []

        def at(node: ElementTree.Element, cell: bool) -> int:
            if node in number:
                in_cells[number[node]] = cell
                return number[node]
            others.append(self.cell(node) if cell else self.block(node))
            return len(number) + len(others) - 1

        steps = _numbered(_steps(body, (P, PLACE)), at)
        if len(in_cells) < marked.count(b"<w:place/>"):
            raise ValueError("paragraphs that are not read")
        return steps, [in_cells[k] for k in range(len(in_cells))], others

    def read(self, marked: bytes, pieces: list[bytes]) -> tuple[list, list]:
        """Steps of a main part that _pieces() took apart, and its paragraphs as read; those not met before are read together."""
        layout = self.layouts.get(marked)
        if layout is None:
            layout = self._layout(marked)
            if len(marked) <= LAYOUT_BYTES:
                if len(self.layouts) >= LAYOUTS:
                    self.layouts.clear()
                self.layouts[marked] = layout
        steps, in_cells, others = layout
        blocks, cells = self.blocks, self.cells
        block, cell = blocks.new.get, cells.new.get
        told = [cell(p) if c else block(p) for p, c in zip(pieces, in_cells, strict=True)]
        if None in told:
            new = []
            for k, t in enumerate(told):
                if t is None:
                    told[k] = (cells if in_cells[k] else blocks).again(pieces[k])
                    if told[k] is None:
                        new.append(k)
            shown = b"<w:place/>".join([pieces[k] if pieces[k].endswith(b"</w:p>") else b"<w:p>%b</w:p>" % pieces[k] for k in new])
            nodes = list(ElementTree.fromstring(self.head + shown + b"</w:document>")) if new else []
            if [n.tag for n in nodes] != ([P, PLACE] * len(new))[: max(0, 2 * len(new) - 1)]:
                raise ValueError("a piece is not one paragraph")
            for k, node in zip(new, nodes[::2], strict=True):
                told[k] = self.cell(node) if in_cells[k] else self.block(node)
                (cells if in_cells[k] else blocks).put(pieces[k], told[k])
        return steps, told + others if others else told

    def whole(self, body: ElementTree.Element) -> tuple[list, list]:
        """Steps of a body that is read as one, and its paragraphs; those of cells that are merged with the row above are not read."""
        told: list = []

        def at(node: ElementTree.Element, cell: bool) -> int:
            told.append(self.cell(node) if cell else self.block(node))
            return len(told) - 1

        return _numbered(_steps(body), at, False), told

    def cell(self, p: ElementTree.Element) -> Cell:
        self.pictures = []
        return self.inline(p).strip().replace("\n", "<br>").replace("|", "\\|"), tuple(self.pictures)

    def block(self, p: ElementTree.Element) -> Block:
        self.pictures = []
        kind, text, item = self.paragraph(p)
        return kind, text, item, tuple(self.pictures)

    def paragraph(self, p: ElementTree.Element) -> tuple[str, str, tuple[str, int] | None]:
        props = p.find(PPR)
        code, level, (number, depth) = self.styles.told(None if props is None else _value(props, STYLE))
        text = self.inline(p, plain=code)
        spans = "".join([f'<span id="{b.get(NAME)}"></span>' for b in p.iter(BOOKMARK) if (b.get(NAME) or "") not in ("", "_GoBack")])
        if code:
            return "code", text, None
        text = text.strip()
        outline = _value(props, OUTLINE)
        if outline is not None and outline.isdigit():
            level = min(6, int(outline) + 1) if int(outline) < 9 else 0
        if level and text:
            title = re.sub(r"^(\*\*\*?|\*)(.*)\1$", r"\2", text.replace("\n", " "))
            return "heading", (spans + "\n" if spans else "") + "#" * level + " " + title, None
        own = None if props is None else props.find(NUMBER)
        if own is not None and (given := _value(own, NUMBER_ID)) is not None:
            number, depth = given, _value(own, DEPTH)
        if number not in (None, "0") and text:
            return "item", (spans + text).replace("\n", " "), (number, int(depth or 0))
        return ("text", spans + text, None) if text or spans else ("", "", None)

    def inline(self, parent: ElementTree.Element, plain: bool = False) -> str:
        """Runs, links and pictures of a paragraph; neighbouring runs of one look are one."""
        parts: list[tuple[str, str]] = []  # (look, text)
        self._runs(parent, parts, plain)
        if len(parts) == 1 and not parts[0][0]:
            return parts[0][1]
        out, k = [], 0
        while k < len(parts):
            look, text = parts[k]
            k += 1
            while k < len(parts) and parts[k][0] == look:
                text += parts[k][1]
                k += 1
            bare = text.strip()
            if look and bare:
                a, b = text.index(bare), text.index(bare) + len(bare)
                text = text[:a] + look + bare + look + text[b:]
            out.append(text)
        return "".join(out)

    def _runs(self, parent: ElementTree.Element, parts: list[tuple[str, str]], plain: bool) -> None:
        field: list[str] = []  # instruction and begin of the text of each open field
        begins: list[int] = []
        for node in parent:
            tag = node.tag
            if tag == R_:
                kind = node.find(FIELD)
                kind = None if kind is None else kind.get(W + "fldCharType")
                if kind == "begin":
                    field.append("")
                    begins.append(len(parts))
                elif kind == "end" and field:
                    told, at = field.pop(), begins.pop()
                    m = re.search(r'HYPERLINK\s+(\\l\s+)?"([^"]+)"', told)
                    if m and parts[at:]:
                        parts[at:] = [("", f"[{''.join(t for _, t in parts[at:])}]({'#' if m[1] else ''}{m[2]})")]
                for text in node.iter(TOLD) if field else ():
                    field[-1] += text.text or ""
                self._run(node, parts, plain)
            elif tag in (W + "hyperlink", W + "fldSimple"):
                inner: list[tuple[str, str]] = []
                self._runs(node, inner, plain)
                text = "".join(t for _, t in inner)
                target = self.targets.get(node.get(R + "id") or "", "") + (f"#{node.get(W + 'anchor')}" if node.get(W + "anchor") else "")
                m = re.search(r'HYPERLINK\s+(\\l\s+)?"([^"]+)"', node.get(W + "instr") or "")
                target = target or (("#" if m[1] else "") + m[2] if m else "")
                parts.append(("", f"[{text.strip()}]({target})" if target and text.strip() and not plain else text))
            elif tag in WRAPS:
                self._runs(node, parts, plain)

    def _run(self, run: ElementTree.Element, parts: list[tuple[str, str]], plain: bool) -> None:
        props = run.find(RPR)
        if props is not None and _on(props, "vanish"):
            return
        look = "" if plain or props is None else ("**" if _on(props, "b") else "") + ("*" if _on(props, "i") else "")
        for node in run:
            if node.tag == T:
                parts.append((look, node.text or ""))
            elif node.tag == W + "tab":
                parts.append((look, "\t"))
            elif node.tag in (W + "br", W + "cr"):
                parts.append((look, "\n"))
            elif node.tag == W + "noBreakHyphen":
                parts.append((look, "-"))
            else:
                for blip in [*node.iter(A + "blip"), *node.iter(V + "imagedata")]:
                    target = self.targets.get(blip.get(R + "embed") or blip.get(R + "id") or "", "")
                    if target:
                        self.pictures.append(target)
                        parts.append(("", f"![]({target})"))


@lru_cache(KINDS)
def _kind(head: bytes, styles: bytes | None, relations: bytes | None) -> Kind:
    return Kind(_styles(styles), _relations(relations), head)


class Document:
    """One file's main part, read into blocks of markdown."""

    def __init__(self, pack: Pack):
        main = _raw(pack, "word/document.xml")
        if main is None:
            raise ValueError("no word/document.xml with a body")
        styles, formats, relations = (_raw(pack, f"word/{x}") for x in ("styles.xml", "numbering.xml", "_rels/document.xml.rels"))
        steps = self.taken_apart(main, styles, relations)
        if steps is None:
            body = ElementTree.fromstring(main).find(W + "body")
            if body is None:
                raise ValueError("no word/document.xml with a body")
            steps = Kind(_styles(styles), _relations(relations)).whole(body)
        steps, told = steps
        self.numbering = Numbering(_formats(formats))
        self.pictures: list[str] = []
        self.blocks: list[tuple[str, str]] = []  # (kind, text)
        for step in steps:
            if isinstance(step, list):
                self.blocks.append(("table", self.table(step, told)))
                continue
            kind, text, item, pictures = told[step]
            if pictures:
                self.pictures += pictures
            if item is not None:
                text = "    " * item[1] + f"{self.numbering.mark(*item)} {text}"
            if kind:
                self.blocks.append((kind, text))

    @staticmethod
    def taken_apart(main: bytes, styles: bytes | None, relations: bytes | None) -> tuple[list, list] | None:
        """Steps by paragraphs that are kept; None where the part has to be read as one, also for naming what is wrong with it."""
        apart = _pieces(main)
        if apart is None or max(len(apart[0]), len(styles or b""), len(relations or b"")) > SHARED_BYTES:
            return None
        try:
            return _kind(apart[0], styles, relations).read(*apart[1:])
        except Exception:
            return None

    def table(self, rows: list, told: list) -> str:
        """A pipe table as wide as its widest row; cells over several columns leave the next ones empty, as do those merged with the row above."""
        made = []
        for row in rows:
            cells: list[str] = []
            if isinstance(row, tuple):
                for k in row:
                    text, pictures = told[k]
                    if pictures:
                        self.pictures += pictures
                    cells.append(text)
                made.append(cells)
                continue
            for some, below, more in row:
                lines = []
                for text, pictures in () if below else [told[k] for k in some]:
                    self.pictures += pictures
                    if text:
                        lines.append(text)
                cells.append("<br>".join(lines))
                if more > 0:
                    cells += [""] * more
            made.append(cells)
        if not made:
            return ""
        width = max(map(len, made))
        line = lambda r: "| " + " | ".join(r if len(r) == width else [*r, *[""] * (width - len(r))]) + " |"
        return "\n".join([line(made[0]), "|" + "---|" * width, *map(line, made[1:])])

    def markdown(self) -> str:
        """Blocks with blank lines between, but for the items of a list and the lines of a fence."""
        out: list[str] = []
        before = ""
        for kind, text in self.blocks:
            if kind == "code" and before == "code":
                out[-1] = out[-1][:-4] + "\n" + text + "\n```"
            elif kind == "code":
                out.append("```\n" + text + "\n```")
            elif kind == "item" and before == "item":
                out[-1] += "\n" + text
            elif text:
                out.append(text)
            before = kind
        return "\n\n".join(out) + "\n" if out else ""


def convert(content: bytes | None) -> tuple[str, list[tuple[str, str, int, int, str]]]:
    """Markdown of a file, and its pictures: name, target, first place among pictures, bytes and digest (of a missing one -1 and '')."""
    if content is None:
        raise ValueError("no content")
    pack = Pack(content)
    document = Document(pack)
    found, total = [], 0
    for place, target in enumerate(dict.fromkeys(document.pictures)):
        name = posixpath.normpath(posixpath.join("word", target)) if not target.startswith("/") else target[1:]
        size = pack.size(name)
        if size is None:
            found.append((posixpath.basename(target), target, place, -1, ""))
            continue
        total += size
        if total > MOST_MEDIA:
            raise ValueError("pictures are too large")
        raw = pack.read(name)
        found.append((posixpath.basename(target), target, place, len(raw), hashlib.sha256(raw).hexdigest()))
    return document.markdown(), found


_PICTURE = pa.struct([("name", pa.string()), ("target", pa.string()), ("place", pa.int32()), ("size", pa.int64()), ("sha256", pa.string())])


def to_markdown(files: DataFrame) -> DataFrame:
    """files(path, content) -> path, body, pictures, error; one file a row in any case."""
    ship(files.sparkSession)

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            bodies, errors, pictures, ends = [], [], [], [0]
            for content in part.column("content"):
                try:
                    body, found = convert(content.as_py())
                    pictures += found
                    error = None
                except Exception as e:  # the file is named; the others go on
                    body, error = None, f"{type(e).__name__}: {e}"
                bodies.append(body)
                errors.append(error)
                ends.append(len(pictures))
            fields = list(zip(*pictures, strict=True)) or [()] * len(_PICTURE)
            rows = pa.StructArray.from_arrays([pa.array(v, f.type) for v, f in zip(fields, _PICTURE, strict=True)], fields=list(_PICTURE))
            listed = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), rows)
            yield pa.RecordBatch.from_arrays([part.column("path").cast(pa.string()), pa.array(bodies, pa.string()), listed, pa.array(errors, pa.string())], names=["path", "body", "pictures", "error"])

    return files.select("path", "content").mapInArrow(run, SCHEMA)


def read(spark: SparkSession, path: str) -> DataFrame:
    """All .docx files below a path of any store, as to_markdown() gives them; files without any bytes, which Spark's scan passes over, give no row."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.docx").option("recursiveFileLookup", "true").load(path)
    return to_markdown(files.select(F.col("path"), F.col("content")))
