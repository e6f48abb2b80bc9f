"""Literal cases and properties of the operators."""

import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.errors import ParseException
from pyspark.sql import functions as F

from quarry.graph import connected_components
from quarry.operators import evaluate, inventory, neardup, normalize, relations, search, versions
from quarry.plans import sqlapi
from quarry.sources import markdown


def test_edges(spark):
    rng = random.Random(5)
    kinds = {"k1": "place", "k2": "place", "k3": "tool", "k4": "tool", "k5": "name"}
    rows = [(rng.randint(1, 6), rng.randint(0, 2), k, kinds[k]) for k in rng.choices(list(kinds), k=60)]
    found = spark.createDataFrame([(d, s, t, k) for d, s, k, t in rows], "doc_id long, section long, type string, entity_id string")
    want = {}
    for d, _, k, _ in rows:
        want[str(d), "mentions", k] = want.get((str(d), "mentions", k), 0) + 1
    for d, s in {(d, s) for d, s, _, _ in rows}:
        here = sorted({k for x, y, k, _ in rows if (x, y) == (d, s)})
        for i, a in enumerate(here):
            for b in here[i + 1 :]:
                want[a, "cooccurs", b] = want.get((a, "cooccurs", b), 0) + 1
    for a in range(1, 7):
        for b in range(a + 1, 7):
            n = len({k for d, _, k, t in rows if d == a and t != "name"} & {k for d, _, k, t in rows if d == b and t != "name"})
            if n:
                want[str(a), "xref", str(b)] = n
    got = {(r.src, r.rel, r.dst): r.weight for r in relations.edges(found, ["place", "tool"]).collect()}
    assert got == want
    assert relations.edges(found.limit(0), ["place"]).count() == 0


def test_shingles(spark):
    df = spark.createDataFrame([("a b c d",), ("A b",), ("",)], "t string")
    assert [sorted(r[0]) for r in df.select(neardup.shingles(F.col("t"))).collect()] == [["a b c", "b c d"], ["a b"], []]


def test_minhash_is_the_exact_family(spark):
    texts = ["one two three four five", "x", "", "one two three four six " * 20]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.signature for r in neardup.minhash(df, permutations=16).collect()}
    h = F.transform(neardup.shingles(F.col("text")), neardup.shingle_hash)
    for i in (0, 7, 15):
        assert {r[0]: r[1] for r in df.select("doc_id", neardup.minhash_exact(h, i)).collect()} == {k: v[i] for k, v in got.items()}
    assert got[2] == [2**32 - 1] * 16


@settings(max_examples=200, deadline=None)
@given(st.integers(1, neardup.PRIME - 1), st.integers(0, neardup.PRIME - 1), st.integers(0, 2**64 - 1))
def test_permutation(a, b, h):
    assert int(neardup._permuted(np.array([h], np.uint64), np.array([[a, b]], np.uint64))[0, 0]) == (a * h + b) % neardup.PRIME


def test_clusters_join_all_banded_pairs(spark, monkeypatch):
    monkeypatch.setattr(neardup, "BUCKET", 4)
    rng = random.Random(3)
    words = [f"w{i}" for i in range(400)]
    texts = []
    for _ in range(12):
        base = [rng.choice(words) for _ in range(60)]
        for _ in range(rng.randint(1, 9)):
            some = list(base)
            for _ in range(rng.randint(0, 3)):
                some[rng.randrange(60)] = rng.choice(words)
            texts.append(" ".join(some))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    signed = neardup.minhash(docs).cache()
    got = {r.doc_id: r.cluster for r in neardup.clusters(signed, "doc_id", 0.8, 128).collect()}
    s = {r.doc_id: r.signature for r in signed.collect()}
    bands = neardup.auto_bands(128, 0.8)
    rows = 128 // bands
    root = {i: i for i in s}
    find = lambda x: x if root[x] == x else find(root[x])
    exact = near = 0
    sets = {i: {" ".join(t.split()[k : k + 3]) for k in range(58)} for i, t in enumerate(texts)}
    for i in s:
        for j in range(i):
            meets = any(s[i][b * rows : (b + 1) * rows] == s[j][b * rows : (b + 1) * rows] for b in range(bands))
            if meets and sum(x == y for x, y in zip(s[i], s[j], strict=True)) / 128 >= 0.8:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
            if len(sets[i] & sets[j]) >= 0.85 * len(sets[i] | sets[j]):
                exact += 1
                near += got[i] == got[j]
    assert got == {i: find(i) for i in s}
    assert exact > 20 and near >= 0.9 * exact


def test_auto_bands():
    assert 128 % neardup.auto_bands(128, 0.8) == 0 and neardup.auto_bands(4, 0.0) == 4


def test_components(spark):
    rng = random.Random(0)
    edges = [(rng.randint(0, 300), rng.randint(0, 300)) for _ in range(180)] + [(1000 + i, 1001 + i) for i in range(60)] + [(7000, 7000), (None, 3)]
    root: dict = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in edges:
        if a is not None:
            a, b = find(a), find(b)
            root[max(a, b)] = min(a, b)
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "src long, dst long")).collect()}
    assert got == {x: find(x) for x in root}


def test_sections(spark):
    body = "intro\n# A\ntext of a section that has more than eight words in it\n## Example\n```\n# not a heading\n```\n## Example\n### Deep\nx\n# B"
    got = [tuple(r) for r in markdown.sections(spark.createDataFrame([(1, body)], "doc_key long, body string")).orderBy("seq").select("title", "level", "path", "slug", "kind").collect()]
    assert got == [("A", 1, "", "a", "ok"), ("Example", 2, "A", "example", "hollow"), ("Example", 2, "A", "example-1", "container"), ("Deep", 3, "A > Example", "deep", "hollow"), ("B", 1, "", "b", "hollow")]


def test_demotion():
    def hit(i, title, path="", size=100):
        return {"section_id": i, "section_title": title, "section_path": path, "body_len": size}

    ids = lambda hits: [h["section_id"] for h in search.demote_restating_parents(hits)]
    parent, child, other = hit("p", "Setup"), hit("c", "Setup steps", "Setup", 1700), hit("x", "X", size=500)
    assert ids([parent, other, child]) == ["c", "p", "x"] and ids([other, parent]) == ["x", "p"]
    assert ids([child, other, parent]) == ["x", "c", "p"]
    # The parent's title may be the longer one, and a long parent stays where it is.
    assert ids([hit("p", "Close order AB_12", "Orders"), other, hit("c", "Close order", "Orders > Close order AB_12", 900)]) == ["c", "p", "x"]
    assert ids([hit("p", "Setup", size=400), other, child]) == ["p", "x", "c"]
    assert ids([hit("p", "Setup"), hit("q", "Setup"), child]) == ["c", "p", "q"]
    assert ids([parent, hit("c", "Setup steps", "Setup", 10), hit("d", "Setup steps two", "Setup > Setup steps", 900)]) == ["d", "c", "p"]


def test_query_terms_and_expansion(spark):
    assert search.query_terms("a OR file #17* x_y") == ["OR", "file", "17", "x_y"] and search.phrase("X_Y") == ("x", "y")
    assert search.expansion_clauses(["abc", "ab"], {"ABC": "Alpha Beta", "AB": "No Way"}) == ["alpha beta"]
    rows = [("Q77", "BLUE TABLE"), ("7.5", "RED DESK"), ("44", "LONG CHAIR"), ("XYZ", "SOLO")]
    assert [tuple(r) for r in search.expansion_map(spark.createDataFrame(rows, "canonical string, canonical_name string")).collect()] == [("Q77", "BLUE TABLE")]
    assert search.envelope([])["warning"] and "warning" not in search.envelope([{}])


def test_search_with_phrases_expansions_and_facets(spark):
    import math

    from quarry.session import scratch

    rng = random.Random(9)
    rows = [(i, " ".join(rng.choice("red blue table desk lamp of the".split()) for _ in range(rng.randint(0, 30))), rng.choice(["a", "b"])) for i in range(80)] + [(900, None, None)]
    path = search.build_index(spark.createDataFrame(rows, "k long, body string, kind string"), "k", {"body": 1.0, "kind": 2.0}, scratch(spark, "ix"), facets=("kind",), shown=("body",))
    texts = {k: ((b or "").split(), (c or "").split()) for k, b, c in rows}

    def brute(units, kinds=None):
        d = {k: len(b) + len(c) for k, (b, c) in texts.items()}
        mean, total = sum(d.values()) / len(d), dict.fromkeys(texts, 0.0)
        for u in units:
            f = {k: sum(w * sum(x[i : i + len(u)] == list(u) for i in range(len(x))) for w, x in zip((1.0, 2.0), v, strict=True)) for k, v in texts.items()}
            n = sum(x > 0 for x in f.values())
            idf = max(1e-6, math.log((len(d) - n + 0.5) / (n + 0.5)))
            for k in texts:
                total[k] += idf * f[k] * 2.2 / (f[k] + 1.2 * (0.25 + 0.75 * d[k] / mean)) if f[k] else 0
        hits = [(round(-v, 4), k) for k, v in total.items() if v > 0 and (not kinds or dict((r[0], r[2]) for r in rows)[k] in kinds)]
        return [(k, -v) for v, k in sorted(hits)[:10]]

    for text, units, more in (
        ("red lamp red", [("red",), ("lamp",), ("red",)], {}),
        ("red_table", [("red", "table")], {}),
        ("RT lamp RTX", [("rt",), ("lamp",), ("rtx",), ("red", "table")], {"expansions": {"RTX": "Red Table"}}),
        ("desk", [("desk",)], {"facets": {"kind": ["a"]}}),
    ):
        got = [(r.k, r.score) for r in search.search(spark, path, text, **more).orderBy("rank").collect()]
        want = brute(units, more.get("facets", {}).get("kind"))
        assert [k for k, _ in got] == [k for k, _ in want] and np.allclose([s for _, s in got], [s for _, s in want], atol=2e-4), text
    assert search.search(spark, path, "nothing").count() == 0 and search.search(spark, path, "").count() == 0
    words = "a b the c d the tion e f g h i j k l m n o p q r s t the".split()
    shown = spark.createDataFrame([(" ".join(words),), ("",), (None,), ("the end",)], "t string").select(search.snippet(F.col("t"), ["THE", "tion"])).collect()
    best = max(range(len(words) - 15), key=lambda i: (sum(w in ("the", "tion") for w in words[i : i + 16]), -i))
    assert shown[0][0] == ("… " if best else "") + " ".join(f"[{w}]" if w in ("the", "tion") else w for w in words[best : best + 16]) + " …"
    assert [r[0] for r in shown[1:]] == ["", "", "[the] end"]


def test_stores_are_swapped_whole(spark):
    from quarry.operators import stores
    from quarry.session import scratch

    home = scratch(spark, "store")
    rows = spark.createDataFrame([(1, "a"), (2, None)], "k long, v string")
    assert stores.current(spark, home) is None and stores.replace_table(rows, home)
    first = stores.current(spark, home)
    assert not stores.replace_table(rows.orderBy(F.desc("k")), home) and stores.current(spark, home) == first
    assert stores.replace_table(rows.na.fill(""), home) and stores.current(spark, home) != first
    assert {tuple(r) for r in stores.read_table(spark, home).collect()} == {(1, "a"), (2, "")}
    stays, goes = stores.prune(rows, spark.createDataFrame([(2,), (2,)], "k long"), "k")
    assert [r.k for r in stays.collect()] == [2] and [r.k for r in goes.collect()] == [1]
    fresh = stores.put_content(spark.createDataFrame([("x",), ("x",), (None,), ("y",)], "c string"), "c", "txt")
    names = sorted(r.name for r in fresh.collect())
    assert len(names) == 2 and stores.put_content(spark.createDataFrame([("x",)], "c string"), "c", "txt", fresh).count() == 0
    texts = spark.createDataFrame([(f"see {names[0][:64].upper()}.txt",)], "t string")
    assert [r.name for r in stores.unreferenced(fresh, texts, "t").collect()] == names[1:]
    state = stores.upsert(spark.createDataFrame([(1, 5, "old"), (2, 9, "new")], "k long, at long, v string"), spark.createDataFrame([(1, 5, "same time"), (2, 8, "late"), (3, 1, "first")], "k long, at long, v string"), "k", "at")
    assert {tuple(r) for r in state.collect()} == {(1, 5, "same time"), (2, 9, "new"), (3, 1, "first")}


def test_history_is_append_only_and_idempotent(spark):
    old = spark.createDataFrame([(1, "a", []), (2, "b", ["z"])], "k long, body string, superseded array<string>")
    new = spark.createDataFrame([(2, "c"), (3, "d")], "k long, body string")
    once = versions.merge_history(old, new, "k", "body")
    want = [(1, "a", []), (2, "c", ["z", "b"]), (3, "d", [])]
    assert [tuple(r) for r in once.orderBy("k").collect()] == want
    assert [tuple(r) for r in versions.merge_history(once, new, "k", "body").orderBy("k").collect()] == want


def test_lineage_puts_unknown_first(spark):
    rows = [("g", None, "x"), ("g", 0, "y"), ("g", 1, "z")]
    got = versions.lineage(spark.createDataFrame(rows, "g string, patch int, key string"), ["g"], ["patch"], "key").where("is_latest").collect()
    assert [r.key for r in got] == ["z"]


@pytest.mark.parametrize(("kept", "verdict"), [(80, "PASS"), (79, "REVIEW"), (49, "QUARANTINE")])
def test_retention(spark, kept, verdict):
    assert spark.range(1).select(evaluate.retention(F.lit(100), F.lit(kept), F.lit(0)).alias("r")).first().r.verdict == verdict


def test_content_hash(spark):
    a = spark.createDataFrame([(1, "x"), (2, None)], "a long, b string")
    b = spark.createDataFrame([(2, None), (1, "x")], "a long, b string")
    c = spark.createDataFrame([(2, ""), (1, "x")], "a long, b string")
    h = [evaluate.content_hash(t, ["a", "b"]).first().digest for t in (a, b, c)]
    assert h[0] == h[1] != h[2]


def test_selection(spark):
    df = spark.createDataFrame([("a", "x"), ("b", "y")], "p string, q string")
    assert df.where(inventory.selection()).count() == 0
    assert df.where(inventory.selection(everything=True)).count() == 2
    assert df.where(inventory.selection(p=["a", "b"], q=["y"])).count() == 1


def test_guarded_sql(spark):
    sqlapi.publish(spark, {"t": spark.range(10)}, {"t": ["id"]})
    got = sqlapi.query(spark, "SELECT id FROM v_t WHERE id >= :least ORDER BY id", 3, {"least": 5})
    assert [r["id"] for r in got["rows"]] == [5, 6, 7] and got["truncated"]
    assert sqlapi.guarded(spark, "WITH a AS (SELECT id FROM v_t) SELECT ';' AS s, (SELECT max(id) FROM a) AS m FROM a").count() == 10
    spark.range(3).createOrReplaceTempView("hidden")
    for bad in ("DROP VIEW v_t", "SELECT 1; SELECT 2", "", "CREATE TABLE x AS SELECT 1", "SELECT * FROM parquet.`/tmp/x`", "SELECT * FROM hidden", "SELECT (SELECT max(id) FROM hidden)", "SELECT 1 WHERE EXISTS (SELECT 1 FROM hidden)", "SELECT reflect('java.lang.System', 'getProperty', 'user.home')", "WITH a AS (SELECT * FROM hidden) SELECT * FROM a", "SELECT * FROM v_t WHERE id IN (SELECT id FROM hidden)", "SET x=1"):
        with pytest.raises((ValueError, ParseException)):
            sqlapi.guarded(spark, bad)
    spec = lambda version, views, caps=(): {"version": version, "views": views, "capabilities": caps}
    old = spec("1.2", {"v": {"a": "int"}}, ["x"])
    assert sqlapi.lint_bump(old, spec("1.3", {"v": {"b": "int"}}, ["x"])) == ["major version: removed column v.a"]
    assert sqlapi.lint_bump(old, spec("1.3", {"v": {"a": "string"}}, ["x"])) == ["major version: retyped v.a int to string"]
    assert sqlapi.lint_bump(old, spec("1.2", {"v": {"a": "int"}}, ["x", "y"])) == ["minor version: added capability y"]
    assert sqlapi.lint_bump(old, spec("1.3", {"v": {"a": "int"}, "w": {}}, ["x"])) == [] == sqlapi.lint_bump(old, spec("2.0", {}, []))


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet="# ab.\n`<!->", max_size=120))
def test_normalisation_is_idempotent(body):
    once = normalize.normalize_body(body)
    assert normalize.normalize_body(once) == once


def test_oversized_chunks_stay_within_the_bound():
    text = "\n\n".join("word " * n for n in (300, 900, 20, 4000, 7))
    parts = normalize.split_oversized(text)
    assert len(parts) > 1 and all(len(p) <= normalize.HARD for p in parts)
    assert normalize.split_oversized("short") == ["short"]


def test_levels_without_gaps():
    assert normalize.infer_heading_levels("# a\n### b\n##### c\n### d") == "# a\n## b\n### c\n## d"
