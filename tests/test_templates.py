"""Template mining against a plain version, and the use of templates on bodies."""

import collections
import hashlib
import itertools
import re

import pytest

from quarry.operators import neardup, templates
from quarry.plans import template_queries

DOCS = "doc_id long, doc_type string, era string, outline array<struct<level:int,title:string>>, title string, cluster string"


def make(spark, rows):
    """Documents with columns whose names clash with the operators' own."""
    return spark.createDataFrame([(*r, "x", "y") for r in rows], DOCS)


def core(title):
    return " ".join(re.sub(r"^[0-9]+(\.[0-9]+)*\.? +", "", title.strip()).lower().split())


def plain_shingles(titles):
    t = [core(x) for x in titles if x.strip()]
    return {" › ".join(t)} if 0 < len(t) <= 2 else {" › ".join(p) for p in zip(t, t[1:], strict=False)}


def plain_signature(shingles, n=128):
    hashes = [int.from_bytes(hashlib.sha1(s.encode()).digest()[:8], "big") for s in shingles]
    return tuple(min((((a * h + b) % neardup.PRIME) & neardup.MASK for h in hashes), default=neardup.MASK) for a, b in map(neardup.coefficients, range(n)))


def plain_clusters(docs, threshold=0.6):
    """The smallest id of each document's cluster: union-find over pairs that share a band."""
    bands = neardup.auto_bands(128, threshold)
    rows = 128 // bands
    signed = {i: plain_signature(plain_shingles([t for _, t in o])) for i, _, _, o in docs}
    kind = {i: (t, e) for i, t, e, _ in docs}
    up = {i: i for i in signed}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    same = collections.defaultdict(list)
    for i, s in signed.items():
        same[kind[i], s].append(i)
    heads = {}
    for (k, s), ids in same.items():
        heads.setdefault(k, []).append((min(ids), s))
        for i in ids:
            up[find(i)] = find(min(ids))
    for some in heads.values():
        buckets = collections.defaultdict(list)
        for i, s in some:
            for b in range(bands):
                buckets[b, s[b * rows : (b + 1) * rows]].append((i, s))
        for members in buckets.values():
            for (i, s), (j, t) in itertools.combinations(members, 2):
                if find(i) != find(j) and sum(x == y for x, y in zip(s, t, strict=True)) / 128 >= threshold:
                    a, b = sorted((find(i), find(j)))
                    up[b] = a
    return {i: find(i) for i in up}


def plain_templates(docs, least=3, sure=10):
    docs = sorted((i, t, e or "unknown", o) for i, t, e, o in docs if t is not None and i is not None)
    cluster, members = plain_clusters(docs), collections.defaultdict(list)
    for row in docs:
        members[cluster[row[0]]].append(row)
    out = []
    for c, some in members.items():
        if len(some) < least:
            continue
        seen = collections.defaultdict(lambda: {"n": 0, "levels": collections.Counter(), "at": [], "names": collections.Counter(), "repeats": False})
        for _, _, _, o in some:
            mine = collections.Counter(core(t) for _, t in o)
            first = set()
            for pos, (level, t) in enumerate(o):
                s = seen[core(t)]
                s["names"][t] += 1
                s["repeats"] |= mine[core(t)] > 1
                if core(t) not in first:
                    first.add(core(t))
                    s["n"] += 1
                    s["levels"][level] += 1
                    s["at"].append(pos)
        held = sorted((s for s in seen.values() if s["n"] >= max(2, 0.25 * len(some))), key=lambda s: sum(s["at"]) / len(s["at"]))
        sections = [(s["names"].most_common(1)[0][0], s["levels"].most_common(1)[0][0], s["n"] >= 0.5 * len(some), s["repeats"], s["n"]) for s in held]
        name = hashlib.sha256("".join(" ".join(t.lower().split()) + "\n" for t, *_ in sections).encode()).hexdigest()[:8]
        out.append((f"{some[0][1]}:{some[0][2]}:{name}", c, len(some), "auto" if len(some) >= sure else "review", [i for i, *_ in some][:5], sections))
    return sorted(out)


def found(df):
    return sorted((r.template_id, r.cluster, r.doc_count, r.grade, r.sample_doc_ids, [(s.title, s.level, s.required, s.repeatable, s.documents) for s in r.sections]) for r in df.collect())


def test_templates(spark):
    base = [(2, "1. Introduction"), (3, "1.1 Purpose"), (2, "2. Installation"), *[(3, f"2.{k} Step {'abcdefgh'[k]}") for k in range(8)], (2, "3. Back-Out Plan"), (2, "Glossary")]
    rows = []
    for i in range(1, 13):
        o = [*base[: 3 + i % 3], (2, "Introduction" if i % 4 == 0 else "Extra  (a+b)"), *base[3 + i % 3 :]] + ([(2, "Glossary")] if i == 5 else [])
        rows.append((i, "guide", "2010s" if i < 9 else None, o))
    rows += [(20 + i, "guide", "2010s", [(2, "Alpha"), (2, "Beta"), (4, "Gamma")]) for i in range(15)]
    rows += [(40, None, "2010s", base), (None, "guide", "2010s", base), (50, "note", "2010s", []), (51, "note", "2010s", []), (52, "note", "2010s", [(2, " ")]), (60, "note", "2010s", base)]
    want = plain_templates(rows)
    got = templates.mine(make(spark, rows))
    assert found(got) == want and len(want) == 4
    by = {(r.doc_type, r.era, r.cluster): r for r in got.collect()}
    alpha = by["guide", "2010s", 20]
    assert alpha.grade == "auto" and [s.title_pattern for s in alpha.sections] == ["(?i)^alpha$", "(?i)^beta$", "(?i)^gamma$"]
    assert [(s.section_id, s.toc_level) for s in alpha.sections] == [("alpha", True), ("beta", True), ("gamma", False)]
    first = by["guide", "2010s", 1]
    roles = {s.title: s.semantic_role for s in first.sections}
    assert roles["1. Introduction"] == "orientation" and roles["3. Back-Out Plan"] == "back-out" and roles["Extra  (a+b)"] is None
    for s in first.sections:
        assert re.match(s.title_pattern, s.title) and re.match(s.title_pattern, core(s.title))
    assert by["note", "2010s", 50].sections == [] and by["note", "2010s", 50].doc_count == 3  # outlines without titles are alike
    assert templates.mine(make(spark, [])).count() == 0


def test_templates_of_the_tables(spark, sf):
    docs = [(r.doc_id, r.doc_type, r.era, [tuple(s) for s in r.outline]) for r in template_queries.order_outlines(spark, sf).collect()]
    want = plain_templates(docs)
    got = template_queries.template_schemas(spark, sf).collect()
    assert {(r.template_id, r.cluster, r.doc_count, r.grade) for r in got} == {t[:4] for t in want} and len(got) == len(want)
    sections = {r.cluster: [x.split("|") for x in r.sections.split("\n") if x] for r in got}
    for _, c, _, _, _, s in want:
        assert [(x[2], int(x[0]), x[-3] == "required", x[-2] == "repeatable", int(x[-1])) for x in sections[c]] == s


def test_one_type_of_equal_and_near_outlines(spark):
    """A hot bucket: thousands of equal outlines are one row, near ones are compared in blocks."""
    titles = [(2, f"Part {k}") for k in range(60)]
    rows = [(i, "guide", "2010s", titles) for i in range(3000)]
    rows += [(5000 + i, "guide", "2010s", [*titles[: i % 60], (2, f"Own {i}"), *titles[i % 60 :]]) for i in range(600)]
    got = templates.mine(make(spark, rows).select("doc_id", "doc_type", "era", "outline")).collect()
    assert [(r.doc_count, len(r.sections)) for r in got] == [(3600, 60)]


def test_outlines_of_bodies(spark):
    body = "# Manual\n\nSept. 2018\n\n## 1. One\ntext\n```\n## no\n```\n### Two\n"
    docs = spark.createDataFrame([(1, "guide", body), (2, "guide", "no heading"), (3, "guide", None), (4, "guide", "\n" * 45 + "May 1999")], "doc_id long, doc_type string, body string")
    got = {r.doc_id: (r.era, [tuple(x) for x in r.outline]) for r in templates.outlines(docs).collect()}
    assert got == {1: ("2010s", [(2, "1. One"), (3, "Two")]), 2: ("unknown", []), 3: ("unknown", []), 4: ("unknown", [])}


@pytest.mark.parametrize(
    ("body", "want"),
    [
        ("# T\n## Purpose\n\n## Scope\ntext", "# T\n## Scope\ntext"),
        ("## Purpose\n\n### Scope\n\n## Own\nx", "## Purpose\n\n## Own\nx"),
        ("## Purpose\n### Scope\nfilled", "## Purpose\n### Scope\nfilled"),
        ("```\n## Purpose\n```\n## purpose", "```\n## Purpose\n```"),
        ("## Contents\n\n## Purpose", "## Contents\n"),
        ("", ""),
    ],
)
def test_strip_scaffold(body, want):
    # A heading above an empty one is not empty itself in the same pass.
    assert templates.strip_scaffold(body, {"purpose", "scope", "contents"}) == want


def test_title_page():
    cover = "**My Manual**\n\n![seal](a.png)\n\n# Department of Veterans Affairs (OIT)\n\nMarch 2019\n\n"
    text = "## Introduction\ntext\n![figure](b.png)\nin May 2001 it began, and it went on for a long time after that"
    block = "**My Manual**\n\n_Version 1.0 · Published 2019-03_\n\nSource: <http://x>\n\n"
    got = templates.standard_title_page(cover + text, "My Manual", "1.0", "", "2019-03", "http://x")
    assert got == block + text
    assert templates.standard_title_page(got, "My Manual", "1.0", "", "2019-03", "http://x").endswith(text)
    assert templates.standard_title_page(cover + text, "My Manual") == cover + text  # its date was not taken
    flat = "Department of Veterans Affairs\n**Bold**\nApril 2020\n" + "word\n" * 60 + "June 2001"
    assert templates.standard_title_page(flat, "B", published="2020-04") == "**Bold**\n" + "word\n" * 60 + "June 2001"
    plain = "## Start\nx"
    assert templates.standard_title_page(plain, "B", published="2020-04") == plain
    assert "seal" not in templates.without_cover_images(cover + text) and "b.png" in templates.without_cover_images(cover + text)
    assert templates.without_cover_images("![x](y)\n\ntext\n![z](w)") == "\ntext\n![z](w)"


def test_bodies_under_templates(spark, sf):
    mined = {r.template_id: {core(x.split("|")[2]) if False else " ".join(x.split("|")[2].lower().split()) for x in r.sections.split("\n") if x} for r in template_queries.template_schemas(spark, sf).collect()}
    best = {}
    for r in sorted(template_queries.template_schemas(spark, sf).collect(), key=lambda r: (r.doc_count, r.template_id), reverse=True):
        held = best.setdefault((r.doc_type, r.era), r)
        if held.doc_count == r.doc_count and r.template_id < held.template_id:
            best[r.doc_type, r.era] = r
    rows = {r.doc_id: r for r in template_queries.template_bodies(spark, sf).collect()}
    stripped = 0
    for r in template_queries.order_outlines(spark, sf).collect():
        t = best.get((r.doc_type, r.era))
        titles = mined[t.template_id] if t else set()
        dated = r.doc_id % 4 > 0
        parts = [f"{'#' * s.level} {s.title}" + ("\n" if i % 3 == 1 else f"\n\ntext of {s.title}") for i, s in enumerate(r.outline)]
        raw = f"**Order {r.doc_id}**\n\n![logo](x.png)\n\n" + ("March 1999\n\n" if dated else "") + "\n\n".join(parts)
        head, body = raw.split("#", 1)
        body = "#" + body
        head = f"**Order {r.doc_id}**\n\n_Version 1.0 · Published 1999-03_\n\n" if dated else head.replace("![logo](x.png)\n", "")
        want = templates.strip_scaffold(head + body, titles)
        stripped += want != head + body
        assert (rows[r.doc_id].template_id, rows[r.doc_id].published) == (t.template_id if t else "", "1999-03" if dated else None)
        assert rows[r.doc_id].body == hashlib.md5(want.encode()).hexdigest()
    assert stripped


def test_lines_below_the_cover_are_not_looked_at(monkeypatch):
    """Whether a line is furniture is asked of the cover alone, where it was asked twice of every line."""
    asked, furniture = [], templates._furniture
    monkeypatch.setattr(templates, "_furniture", lambda x: (asked.append(x), furniture(x))[1])
    text = "## Introduction\n" + "word\nin May 2001\n![figure](b.png)\n" * 1000
    got = templates.without_cover_images(templates.standard_title_page("**T**\n\nMarch 2019\n\n" + text, "T", published="2019-03"))
    assert got == "**T**\n\n_Published 2019-03_\n\n" + text and len(asked) < 10
    flat = "word\n" * 5000 + "![x](y)"
    assert templates.without_cover_images(templates.standard_title_page(flat, "T", published="2019-03")) == flat and len(asked) < 10 + 3 * templates.COVER


@pytest.mark.parametrize(
    ("lines", "first"),
    [(80, True), (81, False)],
)
def test_a_cover_ends_within_its_lines(lines, first):
    body = "![x](y)\nMarch 2019\n" + "word\n" * (lines - 2) + "## Start\ntext"
    got = templates.standard_title_page(body, "T", published="2019-03")
    assert got == ("**T**\n\n_Published 2019-03_\n\n## Start\ntext" if first else body.replace("March 2019\n", ""))
    assert templates.without_cover_images(body) == body.replace("![x](y)\n", "")


def test_outlines_are_made_once(spark, sf, monkeypatch):
    """Mining and the bodies read the same outlines, where they were made twice."""
    monkeypatch.setattr(template_queries, "_MINED", {})
    plan = template_queries.template_bodies(spark, sf)._jdf.queryExecution().optimizedPlan().toString()
    assert "l_orderkey" not in plan


def test_titles_are_made_plain_once(spark):
    """Titles of an outline are rewritten once, where they were rewritten for each run of two."""
    rows = [(["1. A  b", "2. C", "a B", "c"],), ([],), (["3. One"],), (None,), ([None, "x"],)]
    df = spark.createDataFrame(rows, "t array<string>").select(templates.mining.scaffold_shingles(templates.F.col("t")).alias("s"))
    assert df._jdf.queryExecution().analyzed().toString().count("regexp_replace(regexp_replace") + df._jdf.queryExecution().analyzed().toString().count("regexp_replace(lower(regexp_replace") == 1
    assert [r.s for r in df.collect()] == [["a b › c", "c › a b"], [], ["one"], [None], ["x"]]
