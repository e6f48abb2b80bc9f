"""The search index: grouping, splitting, updates and merges against a full rebuild; many searches against one by one."""

import collections
import os
import random
import shutil

from pyspark.sql import functions as F

from quarry.operators import index, search, stores
from quarry.session import scratch, staged

FIELDS = {"title": 2.0, "body": 1.0}


def rows_of(n=120, seed=3):
    rng = random.Random(seed)
    words = [f"w{int(rng.paretovariate(0.6)) % 80}" for _ in range(400)] + ["Ünï", "the", "of"]
    rows = [(i, " ".join(rng.choice(words) for _ in range(rng.randint(0, 30))), rng.choice(words), rng.choice(["x", "y", None])) for i in range(n)]
    return [*rows, (n, None, None, None), (n + 1, "", "", "x"), (n + 2, "of the of the", "the", "y"), (None, "w1", "w1", "x")]


def make(spark, rows):
    """Chunks with columns whose names clash with the index's own."""
    return spark.createDataFrame([(*r, "c", 7) for r in rows], "k long, body string, title string, kind string, segment string, d long").repartition(3)


def plain_postings(rows):
    out = collections.defaultdict(list)
    for k, body, title, _ in rows:
        if k is not None:
            for f, text in enumerate((title, body)):
                for p, t in enumerate("".join(c if c.isalnum() else " " for c in (text or "").lower()).split()):
                    out[t, k].append((f, p))
    return out


def held(ix):
    return {(r.term, r.k): [tuple(a) for a in r.at] for r in ix.postings().collect()}


def found(spark, path, text, **more):
    return [(r["rank"], r.k, r.score) for r in search.search(spark, path, text, 15, **more).orderBy("rank").collect()]


QUERIES = ["w1 w2", "the", "of_the w3", "w5 w5 the", "the_of_the", "w1 nowhere"]


def build(spark, rows, home=None):
    return search.build_index(make(spark, rows), "k", FIELDS, home or scratch(spark, "ix"), facets=("kind",))


def test_postings_are_grouped_within_rows(spark):
    rows = rows_of()
    ix = index.Index(spark, build(spark, rows))
    want = plain_postings(rows)
    assert held(ix) == want
    assert {(r.term, r.n, r.times) for r in ix.words().collect()} == {(t, sum(1 for u, _ in want if u == t), sum(len(v) for (u, _), v in want.items() if u == t)) for t in {t for t, _ in want}}
    assert ix.n == len(rows) - 1 and index.Index(spark, build(spark, [])).n == 0


def test_common_terms_are_split(spark, monkeypatch):
    monkeypatch.setattr(index, "SPLIT", 20)
    rows = [(i, f"the own{i}", "the", "x") for i in range(200)]
    home = scratch(spark, "split")
    make(spark, rows).select("k", "body", "title", "kind").withColumn("mark", F.lit("m")).createOrReplaceTempView("split_rows")
    segment = index._write_segment(spark.table("split_rows"), "k", FIELDS, home, ["kind"], split=20)
    stored = spark.read.parquet(f"{home}/{segment.name}/postings").withColumn("file", F.input_file_name())
    files = {r.file: r["count"] for r in stored.where("term = 'the'").groupBy("file").count().collect()}
    assert len(files) >= 5 and sum(files.values()) == 200 and max(files.values()) < 80
    assert stored.select("term", "k").distinct().count() == stored.count() == 400


def test_shards_follow_the_tokens():
    assert index.shards_for(0) == index.LEAST_SHARDS and index.shards_for(10**9) == 256 and index.shards_for(10**15) == index.MOST_SHARDS


def test_update_equals_a_rebuild_and_reads_no_posting(spark):
    rows = rows_of()
    home = scratch(spark, "upd")
    build(spark, rows[:100], home)
    now = [(k, (b or "") + " changed of the" if k and k % 30 == 0 else b, t, kind) for k, b, t, kind in rows if k is None or k % 17]
    # With the old postings moved away an update must still work.
    old = [f"{home.removeprefix('file:')}/{s.name}" for s in index.Index(spark, stores.current(spark, home)).segments]
    for p in old:
        os.rename(f"{p}/postings", f"{p}/away")
    path = index.update(make(spark, now), home)
    for p in old:
        os.rename(f"{p}/away", f"{p}/postings")
    ix, whole = index.Index(spark, path), index.Index(spark, build(spark, now))
    assert len(ix.segments) == 2 and ix.segments[1].chunks < 40 and ix.dead_rows > 3
    assert (ix.n, ix.avgdl) == (whole.n, whole.avgdl) and held(ix) == held(whole)
    assert {tuple(r) for r in ix.words().collect()} == {tuple(r) for r in whole.words().collect()}
    for q, facets in ((QUERIES[0], None), (QUERIES[2], {"kind": ["x"]})):
        assert found(spark, path, q, facets=facets) == found(spark, whole.path, q, facets=facets)
    assert index.update(make(spark, now), home) == path  # nothing changed
    merged = index.merge(spark, home, whole=True)
    ix = index.Index(spark, merged)
    assert len(ix.segments) == 1 and ix.dead_rows == 0 and held(ix) == held(whole) and index.merge(spark, home, whole=True) == merged
    assert found(spark, merged, QUERIES[2]) == found(spark, whole.path, QUERIES[2])


def test_additions_without_removals(spark):
    home = scratch(spark, "add")
    rows = rows_of(40)
    build(spark, rows[:10], home)
    path = index.update(make(spark, rows[8:30]), home, whole=False)
    assert held(index.Index(spark, path)) == plain_postings(rows[:30])
    path = index.update(make(spark, [(5, "anew", None, None)]), home, whole=False)
    assert index.Index(spark, path).dead_rows == 1 and found(spark, path, "anew")[0][1] == 5
    path = index.update(make(spark, []), home)
    assert index.Index(spark, path).n == 0 and found(spark, path, "the") == [] and held(index.Index(spark, path)) == {}
    path = index.merge(spark, home, fan=2)
    assert index.Index(spark, path).n == 0 and found(spark, path, "the") == []
    path = index.update(make(spark, rows), home)
    assert held(index.Index(spark, path)) == plain_postings(rows)


def test_segments_of_old_versions_go(spark):
    home = scratch(spark, "gc")
    build(spark, [(1, "a", None, None)], home)
    for k in range(2):
        index.update(make(spark, [(k + 2, "b", None, None)]), home)
        index.merge(spark, home, fan=2)
    names = os.listdir(home.removeprefix("file:"))
    live = {s.name for s in index.Index(spark, stores.current(spark, home)).segments}
    assert live <= set(names) and sum(n.startswith("segment-") for n in names) <= len(live) + 2


def test_what_is_merged():
    s = [index.Segment(f"s{k}", 8, n, n) for k, n in enumerate((1000, 9, 10, 12, 15, 900, 100))]
    assert [[x.name for x in g] for g in index.to_merge(s, {}, fan=4)] == [["s2", "s1", "s3", "s4"]] or sorted(sorted(x.name for x in g) for g in index.to_merge(s, {}, fan=4)) == [["s1", "s2", "s3", "s4"]]
    assert [[x.name for x in g] for g in index.to_merge(s[:1], {"s0": 600}, fan=4)] == [["s0"]] and index.to_merge(s[:1], {"s0": 400}, fan=4) == []


def test_many_searches_equal_single_ones(spark):
    rows = [r for r in rows_of() if r[0] is not None]
    path = build(spark, rows)
    queries = spark.createDataFrame([(f"q{i}", q) for i, q in enumerate([*QUERIES, "", None])], "query string, text string")
    grid = [FIELDS, {"title": 0.0, "body": 1.0}, {"title": 5.0}]
    got = search.search_many(spark, path, queries, 15, grid).collect()
    for i, q in enumerate(QUERIES):
        for p, w in list(enumerate(grid))[i % 3 :][:1]:
            want = [r for r in found(spark, path, q, weights=w)]
            assert [(r["rank"], r.k, r.score) for r in sorted(got, key=lambda r: r["rank"]) if r.query == f"q{i}" and r.point == p] == want, (q, w)
    facets = spark.createDataFrame([("q0", ["x"]), ("q1", None), ("q2", [None])], "query string, kind array<string>")
    narrow = search.search_many(spark, path, queries, 15, facets=facets).collect()
    for i, q in enumerate(QUERIES[:3]):
        want = [] if i == 2 else found(spark, path, q, facets={"kind": ["x"]} if i == 0 else None)
        assert [(r["rank"], r.k, r.score) for r in sorted(narrow, key=lambda r: r["rank"]) if r.query == f"q{i}"] == want
    assert search.search_many(spark, path, queries.limit(0)).count() == 0


def test_terms_of_many_searches_may_be_joined(spark, monkeypatch):
    path = build(spark, [r for r in rows_of() if r[0] is not None])
    queries = spark.createDataFrame(list(enumerate(QUERIES)), "query int, text string")
    want = search.search_many(spark, path, queries).collect()
    monkeypatch.setattr(search, "PUSHED", 1)
    assert sorted(want) == sorted(search.search_many(spark, path, queries).collect()) and want


def test_broken_build_leaves_the_current_index(spark):
    home = scratch(spark, "half")
    path = build(spark, [(1, "a", None, None)], home)
    shutil.copytree(f"{path.removeprefix('file:')}/meta", f"{home.removeprefix('file:')}/version-half/meta")
    assert stores.current(spark, home) == path and found(spark, path, "aa a") == []


def test_products_of_queries_and_chunks_stay_where_they_are(spark):
    """What queries times chunks make is neither shuffled nor as large as a task's memory: hits are dealt by chunk, and a task's part is cut to ranks."""
    from quarry.operators import index, search
    from quarry.session import scratch

    docs = spark.createDataFrame([(n, f"common word{n % 7} tail") for n in range(200)], "id long, body string")
    path = index.build(docs, "id", {"body": 1.0}, scratch(spark, "product"))
    queries = spark.createDataFrame([(q, f"common word{q % 7}") for q in range(20)], "query long, text string")
    found = search.scored(spark, path, queries)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(query" not in plan and found.count() == 20 * 200
    best = search.search_many(spark, path, queries, 3).collect()
    assert len(best) == 60 and all(r["id"] % 7 == r["query"] % 7 for r in best)


def test_points_share_one_ideal(spark):
    """Judged rows are not repeated for each point, and of each query the k best go on to be ranked."""
    from quarry.operators import evaluate

    judged = spark.createDataFrame([(q, n, n % 3) for q in range(4) for n in range(50)], "query long, item long, grade int")
    ranked = spark.createDataFrame([(q, p, r, r * (p + 1)) for q in range(3) for p in range(2) for r in range(1, 6)], "query long, point int, rank long, item long")
    both = evaluate.metrics_by_point(ranked, judged, 2, 5)
    plan = both._jdf.queryExecution().optimizedPlan().toString()
    assert "WindowGroupLimit" in plan
    single = {(r["query"], p): tuple(r)[1:] for p in range(2) for r in evaluate.ranking_metrics(ranked.where(f"point = {p}").drop("point"), judged, 5).collect()}
    assert {(r["query"], r["point"]): tuple(r)[2:] for r in both.collect()} == single and len(single) == 8



def test_common_terms_are_split_by_occurrences(spark, tmp_path):
    """A term that stands often in few chunks takes several files too, and occurrences come back as they were."""
    home, line = f"file://{tmp_path}/often", "w " * 300 + "own"
    rows = spark.createDataFrame([(k, line) for k in range(12)], "k long, text string")
    words = rows.select("k", index.grouped({"text": 1.0}).alias("words"))
    assert [tuple(r) for r in index._common(words, "k", 12, 12 * 301, 1000, a_shard=1000).collect()] == [("w", 4)]
    assert index._common(words, "k", 12, 12 * 301, 1000, a_shard=4000) is None
    path = index.build(rows, "k", {"text": 1.0}, home)
    got = {(r.term, r.k): [tuple(a) for a in r.at] for r in index.Index(spark, path).postings().collect()}
    assert got == {("w", k): [(0, i) for i in range(300)] for k in range(12)} | {("own", k): [(0, 300)] for k in range(12)}


def test_samples_stay_where_they_are_and_files_have_tasks_of_their_own(spark, monkeypatch):
    monkeypatch.setattr(index, "SAMPLE", 100)
    taken = []
    monkeypatch.setattr(index, "staged", lambda df, label, **more: (taken.append((label, df._jdf.queryExecution().optimizedPlan().toString())), staged(df, label, **more))[1])
    chunks = spark.range(0, 2000, 1, 4).selectExpr("id AS k", "concat('every ', 'w', id, ' v', id * 7, ' u', id % 50) AS body").withColumn("mark", F.lit(""))
    home = scratch(spark, "dealt")
    segment = index._write_segment(chunks, "k", {"body": 1.0}, home, [], split=500)
    plan = next(p for label, p in taken if label == "index-sample")
    assert "Limit" not in plan and "Sample" in plan
    rows = spark.read.parquet(f"{home}/{segment.name}/postings").select("shard", "term", F.regexp_extract("_metadata.file_name", "part-([0-9]+)", 1).alias("task"))
    tasks = rows.where("term <> 'every'").groupBy("task").agg(F.countDistinct("shard").alias("n")).collect()
    assert segment.shards == len(tasks) and {r["n"] for r in tasks} == {1}
    parts = rows.where("term = 'every'").groupBy("task").count().collect()
    assert len(parts) == 4 and not {r["task"] for r in parts} & {r["task"] for r in tasks} and sum(r["count"] for r in parts) == 2000


def test_judged_rows_are_counted_and_not_sorted(spark):
    """The ideal and the implied facets come from the numbers of each grade."""
    import math

    from quarry.operators import evaluate

    rows = [(q, n, (n * 7 + q) % 5 - 1) for q in range(3) for n in range(20 * q + 1)]
    judged = spark.createDataFrame(rows, "query long, item long, grade int")
    chunks = spark.range(100).selectExpr("id AS k", "concat('l', id) AS lang")
    found = evaluate.implied_facets(judged, chunks, "k", ["lang"])
    assert "SortAggregate" not in found._jdf.queryExecution().executedPlan().toString()
    graded = {q: sorted((-g, i) for p, i, g in rows if p == q and g > 0) for q in range(3)}
    assert {r["query"]: r["lang"] for r in found.collect()} == {q: [f"l{x[0][1]}"] for q, x in graded.items() if x}
    ideal = evaluate._ideal(judged, 10)
    assert "count(1)" in ideal._jdf.queryExecution().optimizedPlan().toString().split("WindowGroupLimit")[1]
    got = {r["query"]: (round(r["idcg"], 9), r["relevant"]) for r in ideal.collect()}
    assert got == {q: (round(sum((2**-g - 1) / math.log2(n + 2) for n, (g, _) in enumerate(x[:10])), 9), len(x)) for q, x in graded.items() if x}


def test_postings_travel_as_blocks(spark, monkeypatch):
    """A batch's chunks that hold a term are one row of the shuffle, as many as its parts for a common term; nothing is sorted by folder when it is written."""
    chunks = make(spark, rows_of()).where("k IS NOT NULL").coalesce(1)
    want = plain_postings(rows_of())
    for most, parts in ((1_000_000, {}), (40, {}), (1_000_000, {"w1": 3})):
        monkeypatch.setattr(index, "GROUPED", most)
        blocks = index._blocks(chunks, "k", FIELDS, parts).collect()
        got = [((b.term, k), [(x >> 32, x & (2**32 - 1)) for x in at]) for b in blocks for k, at in zip(b["keys"], b["at"], strict=True)]
        assert len(got) == len(want) and dict(got) == want
        if most > 40:
            assert len(blocks) == len({t for t, _ in want}) + sum(n - 1 for n in parts.values()) and {b.part for b in blocks if b.term == "w1"} == set(range(parts.get("w1", 1)))
    written = []
    home, keep = scratch(spark, "blocks"), index.written_as_they_come
    monkeypatch.setattr(index, "written_as_they_come", lambda s: (written.append(1), keep(s))[1])
    build(spark, rows_of(), home)
    assert written and spark.conf.get("spark.sql.maxConcurrentOutputFileWriters", "0") == "0"
