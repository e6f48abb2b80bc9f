"""Shared entities of documents against a plain count, with one entity in every document."""

import collections
import itertools
import random

import pytest

from quarry.operators import relations


@pytest.mark.parametrize("block", [None, 40])
def test_shared_counts(spark, block):
    rng = random.Random(2)
    held = {d: {"all"} | {f"e{int(rng.paretovariate(0.7)) % 60}" for _ in range(rng.randint(0, 4))} for d in range(200)}
    held |= {1000 + d: {"twin", "all"} for d in range(30)} | {2000: {"lone"}, 2001: {"e1"}}
    want = collections.Counter()
    for a, b in itertools.combinations(sorted(held), 2):
        if n := len(held[a] & held[b]):
            want[a, b] = n
    rows = spark.createDataFrame([(d, e, 1) for d, es in held.items() for e in es], "doc long, entity_id string, n int")
    got = relations.shared_counts(rows.select("doc", "entity_id"), block).collect()
    assert {(r.x, r.y): r.weight for r in got} == want and len(got) == len(want)
    assert relations.shared_counts(rows.select("doc", "entity_id").limit(0), block).count() == 0
