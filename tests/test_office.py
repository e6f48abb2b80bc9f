"""Word-processor files to markdown: parts of the format one by one, odd and damaged files."""

import io
import zipfile

import pytest

from quarry.plans import office_queries
from quarry.plans.office_queries import order_file, packed, paragraph
from quarry.sources import office


def body_of(xml, media=None):
    return office.convert(packed(xml, media))[0]


def run(text, look=""):
    return f'<w:r>{f"<w:rPr>{look}</w:rPr>" if look else ""}<w:t xml:space="preserve">{text}</w:t></w:r>'


@pytest.mark.parametrize(
    ("xml", "want"),
    [
        ("", ""),
        (paragraph(""), ""),
        (paragraph("plain # text"), "plain # text\n"),
        (paragraph("Deep", "Own", bookmark="_Ref1"), '<span id="_Ref1"></span>\n## Deep\n'),
        (paragraph(run("All bold", "<w:b/>"), "H2", raw=True), "## All bold\n"),
        (paragraph(run("a", "<w:b/><w:i/>") + run(" b ", '<w:b w:val="0"/>') + run("hidden", "<w:vanish/>") + run("c", "<w:i/>"), raw=True), "***a*** b *c*\n"),
        (paragraph("<w:r><w:t>one</w:t><w:br/><w:t>two</w:t><w:tab/><w:t>three</w:t></w:r>", raw=True), "one\ntwo\tthree\n"),
        (paragraph("<w:ins>" + run("in") + "</w:ins><w:del><w:r><w:delText>out</w:delText></w:r></w:del>", raw=True), "in\n"),
        (paragraph(run("a", "")) if False else paragraph("<w:sdt><w:sdtContent>" + run("held") + "</w:sdtContent></w:sdt>", raw=True), "held\n"),
        ("".join(paragraph(t, number=n) for t, n in (("a", "30"), ("b", "31"), ("c", "30"), ("d", "30"))), "1. a\n    - b\n2. c\n3. d\n"),
        (paragraph("x", number="90") + paragraph("p") + paragraph("y", number="90"), "- x\n\np\n\n- y\n"),
        (paragraph("a(1)", "C") + paragraph("", "C") + paragraph("**", "C"), "```\na(1)\n\n**\n```\n"),
        ('<w:p><w:pPr><w:outlineLvl w:val="2"/></w:pPr>' + run("By outline") + "</w:p>", "### By outline\n"),
        ('<w:p><w:r><w:fldChar w:fldCharType="begin"/></w:r><w:r><w:instrText>HYPERLINK \\l "_Toc1"</w:instrText></w:r><w:r><w:fldChar w:fldCharType="separate"/></w:r>' + run("Go") + '<w:r><w:fldChar w:fldCharType="end"/></w:r></w:p>', "[Go](#_Toc1)\n"),
        ('<w:p><w:fldSimple w:instr="HYPERLINK &quot;http://y/&quot;">' + run("Y") + "</w:fldSimple></w:p>", "[Y](http://y/)\n"),
    ],
)
def test_paragraphs(xml, want):
    assert body_of(xml) == want


def test_tables():
    cell = lambda text, props="": f"<w:tc><w:tcPr>{props}</w:tcPr>{text}</w:tc>"
    nested = "<w:tbl><w:tr>" + cell(paragraph("in|ner")) + "</w:tr></w:tbl>"
    xml = "<w:tbl><w:tr>" + cell(paragraph("wide"), '<w:gridSpan w:val="2"/>') + cell(paragraph("a") + paragraph("b"), '<w:vMerge w:val="restart"/>') + "</w:tr><w:tr>" + cell(nested) + cell(paragraph("")) + cell(paragraph("c"), "<w:vMerge/>") + "</w:tr><w:tr>" + cell(paragraph("short")) + "</w:tr></w:tbl>"
    assert body_of(xml) == "| wide |  | a<br>b |\n|---|---|---|\n| in\\|ner |  |  |\n| short |  |  |\n"
    assert body_of("<w:tbl/>") == ""


def test_pictures():
    blip = '<w:r><w:drawing><a:blip r:embed="p1"/></w:drawing></w:r>'
    body, found = office.convert(packed(paragraph("see " , raw=False) + paragraph(blip, raw=True) + paragraph(blip, raw=True), {"word/media/seal.png": b"x" * 10}))
    assert body.count("![](media/seal.png)") == 2 and [(n, t, p, s) for n, t, p, s, _ in found] == [("seal.png", "media/seal.png", 0, 10)]
    assert office.convert(packed(paragraph(blip, raw=True)))[1] == [("seal.png", "media/seal.png", 0, -1, "")]


def test_odd_files_give_error_rows(spark, tmp_path, monkeypatch):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as pack:
        pack.writestr("word/document.xml", '<!DOCTYPE x [<!ENTITY a "b">]><x>&a;</x>')
    other = io.BytesIO()
    with zipfile.ZipFile(other, "w") as pack:
        pack.writestr("mimetype", "x")
    good = order_file(1, "1-URGENT", [(1, "A", "1999-01-02")])
    files = {"good.docx": good, "cut.docx": good[:300], "empty.docx": b"", "entities.docx": out.getvalue(), "other.docx": other.getvalue(), "not.txt": b"x"}
    (tmp_path / "deep").mkdir()
    for name, content in files.items():
        (tmp_path / "deep" / name).write_bytes(content)
    got = {r.path.rpartition("/")[2]: r for r in office.read(spark, str(tmp_path)).collect()}
    assert set(got) == set(files) - {"not.txt", "empty.docx"}  # a scan passes over files of no bytes
    assert got["good.docx"].error is None and "| 1 | A | 1999-01-02 |" in got["good.docx"].body and got["good.docx"].pictures[0].size == 6
    for name in set(got) - {"good.docx"}:
        assert got[name].body is None and got[name].error and got[name].pictures == []
    assert "entities" in got["entities.docx"].error and "document.xml" in got["other.docx"].error
    rows = spark.createDataFrame([("n", None, "clash"), ("e", bytearray(b""), "clash"), ("g", bytearray(good), "clash"), ("g", bytearray(good), "clash")], "path string, content binary, body string")
    assert sorted((r.path, r.error is None) for r in office.to_markdown(rows).collect()) == [("e", False), ("g", True), ("g", True), ("n", False)]
    assert office.to_markdown(rows.limit(0)).count() == 0
    monkeypatch.setattr(office, "MOST_PART", 10)
    with pytest.raises(ValueError, match="too large"):
        office.convert(good)


def test_long_file():
    body = body_of("".join(paragraph(f"paragraph {i}") for i in range(20_000)))
    assert body.count("\n\n") == 19_999


def test_shared_parts_are_read_once():
    """Of a file like others of its kind one part is read as XML, where it was four."""
    import cProfile
    import pstats

    files = [order_file(n, "1-URGENT", [(i, "N", "1997-01-01") for i in range(4)]) for n in (8, 9)]
    office.convert(files[0])
    profile = cProfile.Profile()
    told, pictures = profile.runcall(office.convert, files[1])
    stats = pstats.Stats(profile)
    assert told.startswith("# Order 9\n") and [p[0] for p in pictures] == ["seal.png"] and "1. line 0\n    - flag N\n2. line 1" in told
    assert sum(n for (_, _, name), (_, n, *_) in stats.stats.items() if name == "XML") == 1
    assert office.convert(files[1])[0] == told  # counts of lists begin anew



def told(content):
    try:
        return office.convert(content)
    except Exception as e:
        return f"{type(e).__name__}: {e}"


def test_paragraphs_met_before_are_not_read_again(monkeypatch):
    """Of a file like others the XML of its new paragraphs alone is read, where it was the whole main part."""
    files = [order_file(n, "1-URGENT", [(i, "N", "1997-01-01") for i in range(7)]) for n in (8, 9)]
    office.convert(files[0])
    read, parse = [], office.ElementTree.fromstring
    monkeypatch.setattr(office.ElementTree, "fromstring", lambda raw: (read.append(len(raw)), parse(raw))[1])
    assert told(files[1])[0].startswith("# Order 9\n") and sum(read) < 600


ODD = [
    '<w:p w:a="1">' + run("a") + '</w:p><w:p w:a="2"/>' + paragraph("b") + "<w:p/>" + '<w:p\n w:a=">">' + run("c") + "</w:p>",
    paragraph('<w:r><w:pict><w:txbxContent><w:p><w:r><w:t>in</w:t></w:r></w:p></w:txbxContent></w:pict></w:r>' + run("out"), raw=True) + paragraph("after"),
    "<!-- <w:p> -->" + paragraph("a") + "<w:p><w:r><w:t><![CDATA[</w:p><w:p>]]></w:t></w:r></w:p>",
    "<w:p>" + run("a") + "</w:p ><w:p>" + run("b") + "</w:p>",
    '<w:p><w:r xmlns:w="urn:other"><w:t>other</w:t></w:r></w:p>' + paragraph("a"),
    '<w:p xmlns:w="urn:other"><w:t>x</w:t></w:p>' + paragraph("a"),
    "<w:ins>" + paragraph("in") + "</w:ins><w:del>" + paragraph("gone") + "</w:del><w:sdt><w:sdtContent>" + paragraph("held", "H2") + "</w:sdtContent></w:sdt>",
    "<w:tbl><w:tr><w:tc>" + paragraph("a|b") + "<w:p/>" + paragraph("c") + "</w:tc><w:tc/></w:tr><w:tr><w:tc><w:tcPr><w:vMerge/></w:tcPr>" + paragraph('<w:r><w:drawing><a:blip r:embed="p1"/></w:drawing></w:r>', raw=True) + "</w:tc></w:tr></w:tbl>",
    "<w:tbl><w:tr><w:tc><w:tcPr><w:gridSpan w:val='x'/></w:tcPr>" + paragraph("a") + "</w:tc></w:tr></w:tbl>",
    paragraph("a", number="30") + "<w:tbl/>" + paragraph("b", number="30") + paragraph("c", number="31") + paragraph("d", number="30") + paragraph("e", number="31"),
    paragraph("<w:r><w:t>a</w:r></w:t>", raw=True),
    "<w:p><w:r></w:p></w:r>" + paragraph("a"),
    paragraph("&none;", raw=True),
    "<w:place/>" + paragraph("a"),
    paragraph("a") + "</w:p><w:p>",
    "<w:p>" + paragraph("a"),
    '<w:p w:a=">"/>' + paragraph("a") + "</w:p>",
]


@pytest.mark.parametrize("k", range(len(ODD)))
def test_a_part_taken_apart_reads_like_the_whole(k, monkeypatch):
    file = packed(ODD[k] + paragraph("end"), {"word/media/seal.png": b"s"})
    got = [told(file), told(file)]
    monkeypatch.setattr(office.Document, "taken_apart", staticmethod(lambda *_: None))
    assert got == [told(file)] * 2


def zipped(parts, comment=b"", extra=b"", way=zipfile.ZIP_STORED):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", way) as pack:
        pack.comment = comment
        for name, content in parts:
            info = zipfile.ZipInfo(name)
            info.extra, info.compress_type = extra, way
            pack.writestr(info, content)
    return out.getvalue()


def test_packs_read_as_zipfile_reads_them():
    body = f"<w:document {office_queries._NS}><w:body>{paragraph('text ' * 50)}</w:body></w:document>"
    parts = [("word/document.xml", body), ("word/styles.xml", office_queries._STYLES), ("word/ä.xml", "x")]
    plain, deflated = zipped(parts), zipped(parts[:2], way=zipfile.ZIP_DEFLATED)
    stream = io.BytesIO()
    stream.seekable = lambda: False  # sizes come behind the data
    with zipfile.ZipFile(stream, "w", zipfile.ZIP_DEFLATED) as pack:
        pack.writestr("word/document.xml", body)
    files = [plain, deflated, zipped(parts, b"said"), zipped(parts, extra=b"\x99\x99\x01\x00x"), zipped(parts[:2], way=zipfile.ZIP_BZIP2), b"front" + plain, plain[:-1], plain + b"x", plain[:40], b"", zipped([]), stream.getvalue()]
    files += [f[:60] + b"~" + f[61:] for f in (plain, deflated)] + [deflated[: k] + b"\xff" + deflated[k + 1 :] for k in range(len(deflated) - 140, len(deflated))]
    with pytest.warns(UserWarning, match="Duplicate"):
        files.append(zipped([("word/document.xml", "no"), *parts]))
    for file in files:
        try:
            with zipfile.ZipFile(io.BytesIO(file)) as pack:
                names = pack.namelist()
                want, sizes = {n: pack.read(n) for n in names}, {n: pack.getinfo(n).file_size for n in names}
        except Exception as e:
            with pytest.raises(type(e)):
                got = office.Pack(file)
                for n in zipfile.ZipFile(io.BytesIO(file)).namelist():
                    got.read(n)
        else:
            got = office.Pack(file)
            assert {n: got.read(n) for n in names} == want and {n: got.size(n) for n in names} == sizes
    assert office.Pack(plain).size("none") is None
    whole = packed(paragraph("a"), {"m/long": b"x" * 5000, "m/short": b"y"})
    with zipfile.ZipFile(io.BytesIO(whole)) as pack:
        again = io.BytesIO()
        with zipfile.ZipFile(again, "w") as other:
            for i in pack.infolist():
                other.writestr(zipfile.ZipInfo(i.filename), pack.read(i), i.compress_type)
    assert again.getvalue() == whole  # as zipfile writes it
