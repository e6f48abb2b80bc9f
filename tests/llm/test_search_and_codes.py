"""Vector codes, exact top-k search and ranked lexical search against plain versions, odd rows among them."""

import collections
import math
import random
import re
import time

import numpy as np
import pytest

from quarry.llm import codes, decontaminate, topk, wand

VECTORS = "vec_id long, embedding array<float>, label int, v string, score string, code string"


def vectors(spark, rows):
    """Vectors with columns whose names clash with the operators' own."""
    return spark.createDataFrame([(i, e, y, "x", None, "z") for i, e, y in rows], VECTORS)


def odd_vectors(seed=3, n=400, dim=16):
    rng = np.random.default_rng(seed)
    rows = [(int(i), rng.normal(size=dim).round(2).tolist(), int(rng.integers(0, 4))) for i in rng.permutation(n) - 40]
    rows += [(1000 + i, rows[7][1], None) for i in range(60)]  # copies
    rows += [(2000, None, 1), (2001, [1.0] * (dim - 1) + [None], 1), (2002, [float("nan")] * dim, 1), (2003, [float("inf")] + [0.0] * (dim - 1), 2), (2020, [0.0] * dim, None)]
    return [*rows, (2040, [], 1), (2060, [1.0, 2.0], 3), (5, rows[3][1], 9), (rows[0][0], rows[1][1], 2)]


def whole(e, scale):
    return [math.floor(scale * float(np.float32(x))) for x in e]


def kept(rows, scale):
    return [(i, whole(e, scale), y) for i, e, y in rows if e and all(x is not None and math.isfinite(x) for x in e)]


# -- op11


def plain_codes(rows, parts=8, entries=16, rounds=6, scale=4096):
    rows = kept(rows, scale)
    rows = [r for r in rows if len(r[1]) == len(min(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1]))[1])]
    rows.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    w = len(rows[0][1]) // parts
    books = [[r[1][p * w : p * w + w] for r in rows[:entries]] for p in range(parts)]
    far = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b, strict=True))
    near = lambda v, p: min(range(len(books[p])), key=lambda k: (far(v[p * w : p * w + w], books[p][k]), k))
    for _ in range(rounds):
        new = []
        for p in range(parts):
            by = collections.defaultdict(list)
            for _, v, _ in rows:
                by[near(v, p)].append(v[p * w : p * w + w])
            new.append([[sum(c) // len(by[k]) for c in zip(*by[k], strict=True)] if by[k] else old for k, old in enumerate(books[p])])
        books = new
    out = [(i, [near(v, p) for p in range(parts)], sum(far(v[p * w : p * w + w], books[p][near(v, p)]) for p in range(parts)), y) for i, v, y in rows]
    labels = collections.Counter()
    for _, _, e, y in out:
        labels[y] += e
    return [(i, "".join(f"{k:02x}" for k in c), e, labels[y]) for i, c, e, y in out], codes.digest([np.array(b) for b in books])


def test_codes(spark):
    rows = odd_vectors()
    want, book = plain_codes(rows)
    got = codes.encode(vectors(spark, rows)).collect()
    assert collections.Counter((r.vec_id, r.code, r.error, r.label_error) for r in got) == collections.Counter(want)
    assert {r.codebooks_sha256 for r in got} == {book}


@pytest.mark.parametrize("rows", [[], [(1, None, 1)], [(1, [], 1)]])
def test_codes_without_vectors(spark, rows):
    assert codes.encode(vectors(spark, rows)).count() == 0
    assert topk.search(vectors(spark, rows)).count() == 0


def test_codes_of_few_and_tied_vectors(spark):
    rows = [(i, [float(i % 2)] * 8, None) for i in range(1, 6)] + [(None, [0.5] * 8, 1), (9, [3e38] * 8, 1)]
    got = {r.vec_id: r for r in codes.encode(vectors(spark, rows)).collect()}
    # Entries 0 and 2 start equal: the lower one is taken.
    assert got[1].code == "00" * 8 and got[3].code == "00" * 8 and got[2].code == "01" * 8 and len(got) == 7
    assert got[9].error == 0 and got[None].error == 0


def test_bounds_hold_and_save_scans(spark):
    rng = np.random.default_rng(0)
    x = (rng.normal(size=(3000, 1, 8)) * 0.2 + rng.normal(size=(1, 12, 8))).reshape(-1, 8)
    x = np.floor(4096 * x[rng.permutation(len(x))][:5000]).astype(np.int64)
    book = x[:16].copy()
    held, scans = codes.scan(x, book), []
    for _ in range(6):
        was, book = book, codes.means(book, codes.sums_of(x, held.near, 16))
        held, n = codes.reassign(x, was, book, held)
        far = codes.squares(x, book)
        assert (held.near == far.argmin(1)).all()
        own = np.sqrt(far[np.arange(len(x)), held.near])
        far[np.arange(len(x)), held.near] = np.iinfo(np.int64).max
        assert (held.upper >= own).all() and (held.lower <= np.sqrt(far.min(1))).all()
        scans.append(n)
    assert scans[-1] < len(x) / 4
    rows = spark.createDataFrame([(i, None, v, True) for i, v in enumerate((x / 4096).tolist())], "vec_id long, label string, embedding array<double>, sound boolean")
    _, _, counted = codes.train(rows, parts=1)
    assert counted[0] == len(x) and counted[1:] == scans[:5]


# -- op12


def plain_search(rows, k=20, every=20, scale=64):
    rows = [(n, i, v) for n, (i, v, _) in enumerate(kept(rows, scale)) if i is not None]
    out = []
    for n, i, q in rows:
        if i % every == 0:
            found = sorted((-sum(a * b for a, b in zip(q, v, strict=True)), j) for m, j, v in rows if m != n and len(v) == len(q))
            out += [(i, r, j, -s) for r, (s, j) in enumerate(found[:k], 1)]
    return out


def found(df):
    return collections.Counter((r.query_id, r["rank"], r.vec_id, r.score) for r in df.collect())


def test_search(spark):
    rows = [*odd_vectors(), (None, odd_vectors()[0][1], 1)]
    assert found(topk.search(vectors(spark, rows))) == collections.Counter(plain_search(rows))


def test_search_over_tiles(spark, monkeypatch):
    """Many tiles, several query groups, bins of two scores, and scores far apart."""
    for name, value in (("TILE_ROWS", 50), ("TILES", 1), ("MOST_TILE_ROWS", 50), ("TILE_QUERIES", 7), ("SCORES", 300), ("BIN_BITS", 3)):
        monkeypatch.setattr(topk, name, value)
    rng = random.Random(4)
    rows = [(i, [rng.choice([-1.0, 0.0, 0.25, 40.0]) for _ in range(3)], 0) for i in range(700)]  # ties everywhere
    rows += [(800 + i, [2.0**18, 1.0, -(2.0**17)], 0) for i in range(45)]
    assert found(topk.search(vectors(spark, rows), k=5, every=30)) == collections.Counter(plain_search(rows, 5, 30))


def test_products_are_exact():
    rng = np.random.default_rng(1)
    for most in (8, 2000, 2**22, 2**26):
        a, b = (rng.integers(-most, most, (9, 16)) for _ in range(2))
        assert (topk.products(a, b).astype(object) == a.astype(object) @ b.astype(object).T).all()


def test_tiling_follows_the_table():
    assert topk.tiling(10_000, 500, 64) == (2, 1)
    across, down = topk.tiling(10**9, 5 * 10**7, 64)
    assert across == -(-(10**9) // topk.MOST_TILE_ROWS) and down == -(-5 * 10**7 // topk.TILE_QUERIES)
    assert topk.tiling(10**9, 1, 4096)[0] * topk.TILE_BYTES >= 10**9 * 4096 * 8


# -- op13


def plain_terms(text):
    return [re.sub("[A-Z]", lambda m: m[0].lower(), w) for w in re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", text or "")]


def plain_ranks(docs, items, k=50):
    held = [(i, w) for i, w in ((i, plain_terms(t)) for i, t in docs) if w]
    n, length = len(held), sum(len(w) for _, w in held)
    df = collections.Counter(t for _, w in held for t in set(w))
    out = []
    for item, text in items:
        scores = []
        for i, w in held:
            m = 100 - 50 + 50 * len(w) * n // length
            tf = collections.Counter(w)
            s = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (1000000000 * tf[t] // (1000 * tf[t] + 20 * m)) for t in set(plain_terms(text)) if t in tf)
            if s > 0:
                scores.append((-s, i is None, i or 0))
        out += [(item, r, None if none else i, -s) for r, (s, none, i) in enumerate(sorted(scores)[:k], 1)]
    return out


def lexical(spark, docs, items):
    return spark.createDataFrame([(i, t, "x", "y", "z") for i, t in docs], "doc_id long, text string, n string, term string, rank string").repartition(5), spark.createDataFrame([(i, t, "x") for i, t in items], "item_id long, text string, score string")


def texts(seed=6, n=300):
    rng = random.Random(seed)
    words = [f"w{int(rng.paretovariate(0.5)) % 900}" for _ in range(3000)] + ["Ünï", "ÉTÉ", "été", "a", "A", "x1"]
    docs = [(i, " ".join(rng.choice(words) for _ in range(rng.randint(1, 120)))) for i in rng.sample(range(-50, 5000), n)]
    docs += [(6000 + i, docs[3][1]) for i in range(80)]  # equal scores
    docs += [(7000, None), (7001, ""), (7002, " .,-\n\t"), (7003, "w1 w2 " * 30_000), (None, docs[4][1]), (docs[5][0], docs[6][1]), (7004, "a\u0000b \u001cW1--w2")]
    items = [(j, " ".join(rng.choice(words) for _ in range(rng.randint(1, 40)))) for j in range(25)]
    return docs, [*items, (100, docs[3][1]), (101, None), (102, ""), (103, "nowhere"), (5, "w1"), (None, "w2 w3"), (104, "w1 w1 w2")]


def ranks(df):
    return collections.Counter((r.item_id, r["rank"], r.doc_id, r.score) for r in df.collect())


@pytest.mark.parametrize(("k", "block_terms", "shard_docs"), [(50, 500_000, 16384), (7, 60, 20)])
def test_lexical_search(spark, k, block_terms, shard_docs):
    docs, items = texts()
    got = ranks(wand.search(*lexical(spark, docs, items), k=k, block_terms=block_terms, shard_docs=shard_docs))
    assert got == collections.Counter(plain_ranks(docs, items, k))


def test_lexical_search_of_empty_tables(spark):
    docs, items = texts(n=5)
    assert wand.search(*lexical(spark, [], items)).count() == 0
    assert wand.search(*lexical(spark, docs, [])).count() == 0
    assert wand.search(*lexical(spark, [(1, None)], [(1, "a")])).count() == 0


def test_walk_scores_few_documents():
    """Once the heap holds documents with a rare term, those with common terms alone are passed over."""
    rng = np.random.default_rng(2)
    size = 200_000
    common = [(at := np.flatnonzero(rng.random(size) < 0.4), rng.integers(1, 50, len(at))) for _ in range(10)]
    rare = [(at := np.sort(rng.choice(size, 300, replace=False)), rng.integers(5000, 9000, len(at))) for _ in range(3)]
    lists = [(at, x, int(x.max())) for at, x in common + rare]
    dense = np.zeros(size, np.int64)
    for at, x, _ in lists:
        dense[at] += x
    order = np.lexsort((np.arange(size), -dense))[:50]
    scored = []

    class Seen(np.ndarray):
        def __getitem__(self, at):
            scored.append(np.size(at))
            return np.asarray(self)[at]

    at, scores = wand.walk([(d, x.view(Seen), m) for d, x, m in lists], size, 50)
    assert (at == order).all() and (scores == dense[order]).all()
    assert sum(scored) < 0.1 * sum(len(d) for d, _, _ in lists)
    # A threshold from elsewhere ends a walk that cannot beat it.
    assert len(wand.walk(lists, size, 50, threshold=sum(m for _, _, m in lists))[0]) == 0


# -- op10: work that does not grow with the items that share a run


def test_templated_benchmark_is_linear_in_hits():
    start = b"which of the following is the best"
    items = [(start + b" " + b" ".join(b"i%d_%d" % (i, k) if k > 2 else b"answer" for k in range(30)), [str(i)]) for i in range(2000)]
    match = decontaminate.Matcher(items)
    text = (start + b" x ") * 2000 + start + b" answer answer answer"
    began = time.time()
    spans, ids = match.hits(text.split())
    assert time.time() - began < 0.5
    assert spans == [] and ids == set()
    whole = items[77][0].split()
    spans, ids = match.hits(text.split() + whole)
    assert ids == {"77"} and spans[-1][1] - spans[-1][0] == len(whole)
    shared = [(start + b" now one two three four five six %d" % i, [str(i)]) for i in range(2000)]  # all share a window
    spans, ids = decontaminate.Matcher(shared).hits((start + b" now one two three four five six").split())
    assert len(ids) == 2000 and spans == [(0, 14)]


def test_one_repeated_word():
    began = time.time()
    match = decontaminate.Matcher([(b" ".join([b"w"] * 800), ["a"]), (b" ".join([b"w"] * 13), ["b"]), (b"w w", ["c"])])
    spans, ids = match.hits([b"w"] * 20_000 + [b"x"] + [b"w"] * 12)
    assert spans == [(0, 20_000), (20_001, 20_013)] and ids == {"a", "b", "c"}
    assert time.time() - began < 0.5
