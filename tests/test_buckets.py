"""Hot buckets of near-duplicates: members tied to pivots, the rest exact, against all pairs; recurring blocks of bodies."""

import itertools
import random

import numpy as np

from quarry.operators import mining, neardup


def plain(signed, threshold, bands):
    rows = 128 // bands
    up = {i: i for i in signed}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for i, j in itertools.combinations(sorted(signed), 2):
        a, b = signed[i], signed[j]
        if any(a[k : k + rows] == b[k : k + rows] for k in range(0, 128, rows)) and sum(x == y for x, y in zip(a, b, strict=True)) / 128 >= threshold:
            x, y = sorted((find(i), find(j)))
            up[y] = x
    return {i: find(i) for i in up}


def test_hot_bucket(spark, monkeypatch):
    rng = random.Random(8)
    big = 2**32
    band = [rng.randrange(big) for _ in range(8)]
    group = lambda n, changed: [[band + [x if rng.random() > changed else rng.randrange(big) for x in base] for _ in range(n)] for base in [[rng.randrange(big) for _ in range(120)]]][0]
    rows = group(260, 0.04) + group(120, 0.08) + group(40, 0.11) + [band + [rng.randrange(big) for _ in range(120)] for _ in range(60)]
    rows += [list(r) for r in rows[:30]] + [[2**32 - 1] * 128] * 3
    signed = dict(enumerate(rows))
    monkeypatch.setattr(neardup, "BUCKET", 32)
    seen = {}
    real = neardup._pivoted

    def watched(members, one, threshold, bucket):
        placed, edges = real(members, one, threshold, bucket)
        seen["rest"] = placed.where(f"c = 0 AND h = {placed.groupBy('h').count().orderBy('count', ascending=False).first()['h']}").count()
        return placed, edges

    monkeypatch.setattr(neardup, "_pivoted", watched)
    frame = spark.createDataFrame(list(signed.items()), "doc_id long, signature array<long>")
    got = {r.doc_id: r.cluster for r in neardup.clusters(frame, "doc_id", 0.8, 128, 16).collect()}
    assert got == plain(signed, 0.8, 16)
    assert seen["rest"] < 250  # of 480 different ones; the large groups went to their pivots


def test_bands_in_batches(spark, monkeypatch):
    """Buckets whose members earlier bands have joined send nothing; the components are those of all bands at once."""
    rng = random.Random(9)
    big = 2**32
    base = [rng.randrange(big) for _ in range(128)]
    near = lambda head, changed: head + [x if rng.random() > changed else rng.randrange(big) for x in base[len(head) :]]
    joined = [near(base[:8], 0.05) for _ in range(60)]
    signed = dict(enumerate(joined + [near([], 0.1) for _ in range(150)] + [near([], 0.5) for _ in range(20)] + joined[:3]))
    monkeypatch.setattr(neardup, "AT_ONCE", 0)
    assert [list(b) for b in neardup._batches(16, 9)] == [[0], [1, 2], [3, 4, 5, 6], list(range(7, 16))]
    frame = lambda part: spark.createDataFrame(list(part.items()), "doc_id long, signature array<long>")
    assert neardup.links(frame({i: signed[i] for i in range(60)}), "doc_id", 0.8, 16, 128).count() == 59
    monkeypatch.setattr(neardup, "BUCKET", 32)
    got = {r.doc_id: r.cluster for r in neardup.clusters(frame(signed), "doc_id", 0.8, 128, 16).collect()}
    assert got == plain(signed, 0.8, 16)


def test_groups_apart(spark):
    one = [7] * 128
    frame = spark.createDataFrame([(1, one, "a"), (2, one, "b"), (3, one, "a"), (4, [7] * 120 + [8] * 8, "b"), (5, [7] * 120 + [9] * 8, None)], "doc_id long, signature array<long>, kind string")
    got = {r.doc_id: r.cluster for r in neardup.clusters(frame.na.fill("none"), "doc_id", 0.8, 128, within=["kind"]).collect()}
    assert got == {1: 1, 2: 2, 3: 1, 4: 2, 5: 5}


def test_recurring_blocks(spark):
    body = "# Head\n\n  Short  line \n\n[Back](#contents)\n\n<img src='x'>\n![y](z)\n \t\n" + "a long block of words that says one thing in many documents\nover two lines"
    rows = [(i, body if i % 2 else body.upper() + f"\n\nown {i}\n\nshort line\n\nshort line") for i in range(12)] + [(20, None), (21, "")]
    got = {r.block: (r.documents, r.first, r.shape, r.disposition, r.grade) for r in mining.recurring_blocks(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {
        "# head": (12, 0, "template", "retain", "auto"),
        "short line": (12, 0, "phrase", "delete", "review"),
        "a long block of words that says one thing in many documents over two lines": (12, 0, "boilerplate", "reference", "auto"),
    }


def test_texts_of_blocks_are_moved_once(spark, monkeypatch):
    kept, real = {}, mining.staged
    monkeypatch.setattr(mining, "staged", lambda df, label: kept.setdefault(label, df.columns) and real(df, label))
    line = "a long line of words that says one thing in many documents and goes on for a while "
    rows = [(i, f"{line}\n{line.upper()}\nown {i}") for i in range(3)] + [(i, f"{line} to its end") for i in range(3, 12)] + [(12, None)]
    got = {tuple(r) for r in mining.boilerplate_clusters(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {(f"{line}to its end".strip(), 12, 2, "auto")} or got == {(f"{line}to its end".strip(), 9, 1, "review"), (line.strip(), 3, 1, "review")}
    assert "block" not in kept["blocks-of-documents"]


def test_signatures_by_blocks():
    family = np.array([neardup.coefficients(i) for i in range(128)], np.uint64)
    hashes, sizes = np.random.default_rng(3).integers(0, 2**64, 1500, dtype=np.uint64), np.array([0, 700, 1, 0, 799])
    assert (neardup.signatures(hashes, sizes, family) == neardup.signatures(hashes, sizes, family, 2048)).all()
    assert neardup.BLOCK * len(family) * 8 <= 2**18  # several such arrays are in a core's cache
