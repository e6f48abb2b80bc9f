"""Operators of the library that SQL cannot express, against plain versions."""

import random
import re

from pyspark.sql import functions as F

from quarry.functions import text as T
from quarry.operators import catalog, chunking, mining, resolve
from quarry.plans import catalog as plans


def plain_units(sections, target, merge):
    units, run = [], []

    def close():
        if run:
            units.append((run[0][0], "\n\n".join(r[2] for r in run), [r[0] for r in run]))
            run.clear()

    for name, path, text, searchable in sections:
        if not searchable:
            close()
        elif not merge or not path or len(text) >= target:
            close()
            units.append((name, text, [name]))
        else:
            if run and (run[0][1] != path or sum(len(r[2]) for r in run) + len(text) > target):
                close()
            run.append((name, path, text))
    close()
    return units


def test_chunk_units(spark):
    rng = random.Random(4)
    docs = {d: [(f"{d}/{i}", rng.choice(["", "a", "a", "b"]), "x" * rng.randint(0, 60), rng.random() < 0.9) for i in range(rng.randint(0, 40))] for d in range(12)}
    rows = [(d, i, s, "t", p, t, ok) for d, v in docs.items() for i, (s, p, t, ok) in enumerate(v)]
    found = spark.createDataFrame(rows, "doc long, seq long, section_id string, title string, path string, text string, searchable boolean")
    for merge in (True, False):
        got = {}
        for r in chunking.chunk_units(found, "doc", 100, merge).collect():
            got.setdefault(r.doc, []).append((r.section_id, r.text, list(r.members)))
        want = {d: plain_units(v, 100, merge) for d, v in docs.items()}
        assert {d: sorted(v) for d, v in got.items()} == {d: sorted(v) for d, v in want.items() if v}
    assert chunking.chunk_units(found.limit(0), "doc").count() == 0


def test_table_windows(spark):
    rng = random.Random(6)
    tables = [(i, rng.choice(["", " Cap "]), [[rng.choice(["", " a ", "b" * rng.randint(1, 30)]) for _ in range(3)] for _ in range(rng.randint(0, 12))]) for i in range(60)] + [(99, None, [])]
    got = {r.k: r.w for r in spark.createDataFrame(tables, "k long, caption string, rows array<array<string>>").select("k", chunking.table_windows(F.col("caption"), F.col("rows"), 60, 90).alias("w")).collect()}
    for k, caption, rows in tables:
        head = (caption or "").strip()
        lines = [" | ".join(c.strip() for c in r) for r in rows if any(c.strip() for c in r)]
        whole = "\n".join(([head] if head else []) + lines)
        if len(whole) <= 90:
            assert got[k] == ([whole] if whole else [])
            continue
        windows, size = [[]], 0
        base = len(head) + 1 if head else 0
        size = base
        for line in lines:
            if windows[-1] and size + len(line) + 1 > 60:
                windows.append([])
                size = base
            windows[-1].append(line)
            size += len(line) + 1
        assert got[k] == ["\n".join(([head] if head else []) + w) for w in windows]


def test_unit_chunks_are_named(spark):
    units = spark.createDataFrame([("s1", "short"), ("s2", "\n\n".join("w" * 50 for _ in range(20))), ("s3", None)], "section_id string, text string")
    got = [(r.chunk_id, len(r.chunk)) for r in chunking.chunks_for_units(units, target=200, hard=300).collect()]
    assert ("s1", 5) in got and ("s3", 0) in got and ("s2", got[1][1]) == got[1] and ("s2#p2", got[2][1]) == got[2] and all(n <= 300 for _, n in got)


def test_entities_are_decoded(spark):
    cases = {"a &amp;lt; b": "a &lt; b", "caf&eacute; &#8217;x&#x2019; &bogus; & &#0; &#1114112;": "café ’x’ &bogus; & &#0; &#1114112;", "none": "none", "&lt;&gt;": "<>", "tail&": "tail&", "&#128512;!": "😀!"}
    got = {r.a: r.b for r in spark.createDataFrame([(x,) for x in cases] + [(None,)], "a string").select("a", T.unescape(F.col("a")).alias("b")).collect()}
    assert got == {**cases, None: None}


def test_dates_and_slugs(spark):
    cases = {"Sept. 2018": "2018-09", "Mar, 2018": "2018-03", "in  MAY   1999!": "1999-05", "Marching 2018": None, "12 June 20181": None, "December 2001 or May 2002": "2001-12"}
    got = {r.a: r.b for r in spark.createDataFrame([(x,) for x in cases], "a string").select("a", T.month_year(F.col("a")).alias("b")).collect()}
    assert got == cases
    assert spark.createDataFrame([(" A \n",), ("a - b_c?",), ("??",)], "t string").select(T.slugify(F.col("t"), fallback="x")).collect() == [("a",), ("a---b_c",), ("x",)]


def test_boilerplate_spellings_qualify_together(spark):
    rng = random.Random(7)
    base = [f"word{rng.randint(0, 99)}" for _ in range(40)]
    spelled = lambda k: " ".join(base[:k] + ["other"] + base[k + 1 :])
    rows = [(1, spelled(3)), (2, spelled(3)), (3, spelled(30)), (4, "unlike " * 20), (5, "short")]
    got = mining.boilerplate_clusters(spark.createDataFrame(rows, "doc_id long, text string"), threshold=0.6).collect()
    assert [(r.block, r.documents, r.spellings, r.grade) for r in got] == [(spelled(3), 3, 2, "review")]


def test_terms_and_swaps(spark):
    products = spark.createDataFrame([("AB", "Able Bodied", ["Site", "SiTe"], True, "x"), ("AC", "", ["SITE", "CAN"], False, "y"), ("AD", None, None, None, None)], "abbr string, full string, match array<string>, enforce boolean, class string")
    terms = resolve.classify_terms(products, spark.createDataFrame([("site",), ("can",)], "word string"))
    got = {r.surface: (r.enforce, r.collides) for r in terms.collect()}
    assert got == {"AB": (True, False), "Able Bodied": (True, False), "Site": (True, True), "SiTe": (True, False), "AC": (False, False), "SITE": (False, True), "CAN": (False, True), "AD": (True, False)}
    assert {r.surface for r in resolve.casing_swaps(terms).collect()} == {"AB", "SiTe", "AD"}


def test_fragments_of_resolved_roots_are_not_open(spark):
    found = spark.createDataFrame([(1, "root", "^AB"), (1, "name", "^AB(7,"), (2, "root", "^AB"), (2, "file", "7"), (3, "file", "8")], "doc long, type string, surface string")
    nodes = spark.createDataFrame([("n7", "7", ["^ab(7,"])], "node string, number string, surfaces array<string>")
    resolved, unresolved = resolve.resolve_mentions(found, nodes, "file", "root")
    assert {(r.doc, r.node) for r in resolved.collect()} == {(1, "n7"), (2, "n7")}
    assert {(r.doc, r.surface) for r in unresolved.collect()} == {(2, "^AB"), (3, "8")}


def test_pages_without_tables_give_their_links(spark):
    pages = spark.createDataFrame([(1, '<a href="a.PDF?x">A</a><table><tr><td>one</td></tr></table>'), (2, None), (3, "")], "k long, html string")
    assert [(r.k, r.url, r.title) for r in catalog.file_rows(pages, "k").collect()] == [(1, "a.PDF?x", "A")]


def test_windows_of_orders_hold_all_lines(spark, sf):
    lines = spark.read.parquet(f"{sf}/lineitem.parquet").count()
    found = plans.QUERIES["table_windows"](spark, sf).collect()
    assert sum(len(re.findall("\n", r.text)) for r in found) == lines
