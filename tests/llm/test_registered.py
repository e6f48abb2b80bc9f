"""Every registered query of the subpackage over whole small tables: against its SQL, or against a plain version."""

import collections
import glob
import hashlib
import os
import zlib

import duckdb
import numpy as np
import pytest
from test_operators import brute_pii, brute_suffixes, closure

from quarry.llm import decontaminate, packing, pii, quality, registry, simhash, toxicity


@pytest.fixture(scope="module")
def tables(spark):
    return {os.path.basename(p)[:-8]: spark.read.parquet(p) for p in glob.glob("/root/testdata/sf0.001/*.parquet")}


@pytest.fixture(scope="module")
def texts(tables):
    return {r.doc_id: r.text or "" for r in tables["documents"].collect()}


@pytest.mark.parametrize("name", sorted(registry.ORACLES))
def test_sql(spark, sf, name):
    con = duckdb.connect()
    for path in glob.glob(f"{sf}/*.parquet"):
        con.sql(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    got, want = registry.QUERIES[name](spark, sf), con.sql(registry.ORACLES[name])
    assert sorted(got.columns) == sorted(want.columns)
    assert collections.Counter(map(tuple, got.select(*want.columns).collect())) == collections.Counter(want.fetchall())


def held_out(i):
    return zlib.crc32(str(i).encode()) % 5 == 0


@pytest.mark.parametrize(("name", "at"), [("op1_quality", 0.3), ("op7_toxicity", 0.5)])
def test_scores(spark, sf, tables, texts, name, at):
    got = {r.doc_id: r for r in registry.QUERIES[name](spark, sf).collect()}
    assert set(got) == set(texts)
    labels = tables["labels"].collect()
    if name == "op1_quality":
        rows = sorted((r.doc_id, texts[r.doc_id], r.quality) for r in labels if r.quality is not None and not held_out(r.doc_id) and r.doc_id in texts)
        score = quality.fit([t for _, t, _ in rows], [y for _, _, y in rows]).score
    else:
        rows = sorted((r.doc_id, texts[r.doc_id], r.toxic) for r in labels if r.toxic is not None and not held_out(r.doc_id) and r.doc_id in texts)
        score = toxicity.fit([t for _, t, y in rows if y], [t for _, t, _ in rows], float(np.mean([y for _, _, y in rows]))).score
    for i, r in got.items():
        assert r.held_out == held_out(i) and r.predicted == int(r.score >= at) and np.isclose(r.score, score(texts[i]), atol=1e-6)


def test_personal_data(spark, sf, texts):
    model = pii.fit(collections.Counter(c[3] for t in texts.values() for c in pii.candidates(t)[1]))
    for r in registry.QUERIES["op2_pii"](spark, sf).collect():
        base = brute_pii(texts[r.doc_id])
        kinds = collections.Counter(k for _, _, k in base)
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(kinds[k] for k in pii.KINDS)
        assert r.base_sha256 == hashlib.sha256(",".join(f"{k}:{a}:{b}" for a, b, k in base).encode()).hexdigest()
        assert r.spans == ",".join(f"{k}:{a}:{b}" for a, b, k in pii.all_spans(texts[r.doc_id], model)[1])


def plain_pieces(texts):
    want = {}
    for i, t in texts.items():
        ids = np.array([*packing.tokenizer().encode(t, add_special_tokens=False).ids, 0], "<u4")
        edges = [0, *range((len(ids) - 1) % 2048 + 1, len(ids), 2048), len(ids)]
        for k, (a, b) in enumerate(zip(edges, edges[1:], strict=False)):
            want[i, k] = (a, b - a, zlib.crc32(ids[a:b].tobytes()))
    return want


def check_packed(rows, texts):
    assert {(r.doc_id, r.piece): (r.start, r.length, r.ids_crc32) for r in rows} == plain_pieces(texts)
    by = collections.defaultdict(list)
    for r in rows:
        by[r.sequence_id].append((r.offset, r.length))
    for x in by.values():
        x.sort()
        assert [o for o, _ in x] == list(np.cumsum([0, *(n for _, n in x)]))[:-1] and sum(n for _, n in x) <= 2048
    assert len(by) <= -(-sum(r.length for r in rows) // 2048) + 1


def test_packing(spark, sf, texts):
    check_packed(registry.QUERIES["op3_packing"](spark, sf).collect(), texts)


def test_suffixes(spark, sf, texts):
    # The plain version works on characters: bytes read as Latin-1 are characters one by one.
    want = brute_suffixes([(i, t.encode().decode("latin-1")) for i, t in texts.items()])
    got = registry.QUERIES["op8_suffixes"](spark, sf).collect()
    assert {(r.doc_id, r.n_bytes, r.n_removed, r.n_spans) for r in got} == {k[:4] for k in want}


def plain_components(prints):
    return closure(sorted(prints), [(a, b) for a in prints for b in prints if a < b and (prints[a] ^ prints[b]).bit_count() <= 4])


def test_simhash(spark, sf, texts):
    prints = {i: simhash.fingerprint(t) for i, t in texts.items()}
    want = plain_components(prints)
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in registry.QUERIES["op9_simhash"](spark, sf).collect()} == {i: (f"{f:016x}", want[i]) for i, f in prints.items()}


def test_pipeline(spark, sf, tables, texts):
    import corpus_pipeline

    labels = sorted((r.doc_id, texts[r.doc_id], r.toxic) for r in tables["labels"].collect() if r.toxic is not None and not held_out(r.doc_id) and r.doc_id in texts)
    tox = toxicity.fit([t for _, t, y in labels if y], [t for _, t, _ in labels], float(np.mean([y for _, _, y in labels])))
    left = {i: t for i, t in texts.items() if tox.score(t) < 0.5}
    groups = plain_components({i: simhash.fingerprint(t) for i, t in left.items()})
    left = {i: t for i, t in left.items() if groups[i] == i}
    windows = {w for r in tables["benchmark"].collect() for x in [decontaminate.words_of(r.text)] for w in (tuple(x[k : k + 13]) for k in range(len(x) - 12))}
    has = lambda w: any(tuple(w[k : k + 13]) in windows for k in range(len(w) - 12))
    left = {i: t for i, t in left.items() if not has(decontaminate.words_of(t))}
    model = pii.fit(collections.Counter(c[3] for t in left.values() for c in pii.candidates(t)[1]))
    left = {i: pii.blank(t, pii.all_spans(t, model)[1]) for i, t in left.items()}
    assert 0 < len(left) < len(texts)
    check_packed(corpus_pipeline.run(spark, sf).collect(), left)


def test_pipeline_of_odd_rows(spark, sf, tmp_path):
    """Nulls in any column, empty and long texts, ties, repeats, clashing columns and empty tables, through every stage."""
    import corpus_pipeline

    long = "word " * 60_000
    rows = [(1, None, None, None, None), (2, "", "en", "s", 0), (2, "", "en", "s", 0), (None, "a b c", "en", None, 3), (4, long, "en", "s", 300_000), (5, long, "de", "s", 300_000), (6, "call +1 (555) 555-1234 now", None, "s", 1)]
    schema = "doc_id long, text string, lang string, source string, n_chars long, score string, fp string, spans string, n_words string, sequence_id string"
    docs = spark.createDataFrame([(*r, "x", None, "y", "z", "0") for r in rows], schema)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    for name, kind in (("labels", "doc_id long, quality int, toxic int"), ("benchmark", "item_id long, text string")):
        spark.createDataFrame([], kind).write.parquet(f"{tmp_path}/{name}.parquet")
    now = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        now = stage(spark, now, str(tmp_path))
        assert now.columns == corpus_pipeline.COLUMNS, name
    kept = sorted(((r.doc_id is None, r.doc_id or 0, r.text) for r in now.collect()), key=str)
    # One of the wordless rows, one of the long ones, and the others.
    assert [(i, (t or "")[:20]) for _, i, t in kept if i] == [(1, ""), (4, long[:20]), (6, "call [PHONE] now")] and sum(n for n, _, _ in kept) == 1
    assert corpus_pipeline.run(spark, str(tmp_path)).select("doc_id").distinct().count() == 4
    assert all(stage(spark, docs.limit(0), str(tmp_path)).count() == 0 for _, stage in corpus_pipeline.STAGES)
