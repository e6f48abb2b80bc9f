"""The knowledge store over runs with verdicts, bundles in volumes, and table functions under the SQL guard."""

import hashlib

import pytest

from quarry.operators import knowledge, release
from quarry.plans import sqlapi, table_functions
from quarry.session import scratch


def test_knowledge_over_runs(spark):
    home = scratch(spark, "kn")
    nodes = lambda rows: spark.createDataFrame(rows, "node string, name string, forms array<string>")
    edges = lambda rows: spark.createDataFrame(rows, "src string, rel string, dst string")
    held = lambda: ({r.node: r for r in knowledge.read(spark, home)[0].collect()}, {(r.src, r.dst): r for r in knowledge.read(spark, home)[1].collect()})
    facts = ["name", "forms"]
    assert knowledge.read(spark, home) is None
    knowledge.run(nodes([("a", "A", ["x"]), ("b", "B", None), ("c", "C", []), ("d", None, None), (None, "no", None)]), edges([("a", "r", "b"), ("b", "r", "c"), ("c", "r", "d"), ("a", "r", "nowhere"), ("a", "r", "b")]), home, "r1", facts)
    n, e = held()
    assert set(n) == set("abcd") and set(e) == {("a", "b"), ("b", "c"), ("c", "d")} and {r.status for r in e.values()} == {"active"}
    knowledge.verify(spark, home, spark.createDataFrame([("a", "verified"), ("b", "verified"), ("c", "rejected")], "node string, verification string"))
    n, e = held()
    assert n["c"].status == "rejected" and e["b", "c"].closed_by == "verdict" and e["a", "b"].status == "active"
    # The run changes a, leaves b out, has c and a new node, and no longer d.
    knowledge.run(nodes([("a", "A2", ["x"]), ("c", "C2", []), ("f", "F", None)]), edges([("a", "r", "f"), ("a", "r", "c")]), home, "r2", facts)
    n, e = held()
    assert (n["a"].name, n["a"].conflict, n["a"].runs) == ("A", '{"name":"A2","forms":["x"]}', ["r1", "r2"])
    assert (n["b"].status, n["b"].runs, n["b"].conflict) == ("active", ["r1"], None)
    assert (n["c"].status, n["c"].name) == ("rejected", "C") and (n["d"].status, n["d"].closed_by) == ("retired", "r2") and n["f"].runs == ["r2"]
    assert (e["a", "f"].status, e["a", "c"].status, e["a", "b"].status, e["a", "b"].closed_by, e["b", "c"].closed_by) == ("active", "closed", "closed", "r2", "verdict")
    # What comes back is active again; the same run twice changes nothing more.
    for _ in range(2):
        knowledge.run(nodes([("a", "A", ["x"]), ("d", "D", None)]), edges([("a", "r", "d")]), home, "r3", facts)
        n, e = held()
        assert (n["d"].status, n["d"].closed_by, n["d"].name, n["d"].runs) == ("active", None, "D", ["r1", "r3"]) and n["a"].conflict is None
        assert e["a", "d"].status == "active" and n["f"].status == "retired" and e["a", "f"].closed_by == "r3"


def test_a_run_that_fails_leaves_the_store(spark, monkeypatch):
    home = scratch(spark, "kf")
    nodes = spark.createDataFrame([("a", "A")], "node string, name string")
    edges = spark.createDataFrame([], "src string, rel string, dst string")
    knowledge.run(nodes, edges, home, "r1", ["name"])

    def broken(*_):
        raise RuntimeError("stop")

    monkeypatch.setattr(knowledge, "merge_edges", broken)  # the nodes of the run are written by then
    with pytest.raises(RuntimeError, match="stop"):
        knowledge.run(nodes.selectExpr("node", "'B' AS name"), edges, home, "r2", ["name"])
    assert [(r.node, r.name) for r in knowledge.read(spark, home)[0].collect()] == [("a", "A")]


def test_volumes_do_not_depend_on_partitions(spark):
    rows = [(f"b{k % 3}", f"f{k}.txt", bytearray(b"x" * (k * 7 % 50)), "clash") for k in range(200)] + [("b0", "none", None, "c"), (None, "n", bytearray(b"x"), "c"), ("b1", None, bytearray(b"x"), "c"), ("big", "one", bytearray(b"y" * 5000), "c")]
    parts = spark.createDataFrame(rows, "bundle string, name string, content binary, archive string")
    packs = [sorted((r.bundle, r.volume, r.parts, r.bytes, r.digest, bytes(r.archive)) for r in release.volumes(parts.repartition(n), 500).collect()) for n in (1, 5)]
    assert packs[0] == packs[1] and len(packs[0]) > 8 and {p[0] for p in packs[0]} == {"b0", "b1", "b2", "big"}
    packed = release.volumes(parts, 500)
    got = {(r.bundle, r.name): bytes(r.content) for r in release.opened(packed).collect()}
    assert got == {(b, n): bytes(c or b"") for b, n, c, _ in rows if b and n}
    told = {r.bundle: r for r in release.manifest(parts, packed).collect()}
    for b, r in told.items():
        mine = [p for p in packs[0] if p[0] == b]
        assert (r.volumes, r.parts, r.bytes) == (len(mine), sum(p[2] for p in mine), sum(p[3] for p in mine))
        assert r.digest == hashlib.sha256("\n".join(p[4] for p in sorted(mine, key=lambda p: p[1])).encode()).hexdigest()
    assert release.volumes(parts.limit(0), 500).count() == 0


def test_table_functions(spark):
    assert table_functions.register(spark) == ["body_sections", "page_links", "table_rows"]
    pages = spark.createDataFrame([(1, '<a href="x">one</a><a href="y">two</a><A HREF="x">again</A><table><tr><td>a<b>b</b></td><th>c &amp; d</th></tr></table>'), (2, None), (3, "")], "page_id long, html string")
    sqlapi.publish(spark, {"tf": pages}, {"tf": ["page_id", "html"]})
    got = sqlapi.guarded(spark, "SELECT page_id, pos, target, label FROM v_tf, LATERAL page_links(html)").collect()
    assert sorted(map(tuple, got)) == [(1, 0, "x", "one"), (1, 1, "y", "two")]
    assert [list(r.cells) for r in sqlapi.guarded(spark, "SELECT cells FROM v_tf, LATERAL table_rows(html)").collect()] == [["ab", "c & d"]]
    with pytest.raises(ValueError, match="no published view"):
        sqlapi.guarded(spark, "SELECT * FROM other, LATERAL page_links(html)")
