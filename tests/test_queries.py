"""Every registered query with SQL gives the SQL's rows; the others give rows."""

import collections
import glob
import math
import os
import re

import duckdb
import pytest

import __spark_entry__ as entry
from quarry.plans import catalog


def rows(columns, found):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    cell = lambda v: "null" if v is None or (isinstance(v, float) and math.isnan(v)) else repr(round(v, 5)) if isinstance(v, float) else str(v)
    return sorted("|".join(cell(r[i]) for i in order) for r in found)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for path in glob.glob("/root/testdata/sf0.001/*.parquet"):
        con.sql(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query(spark, sf, duck, name):
    df = catalog.QUERIES[name](spark, sf)
    got = [tuple(r) for r in df.collect()]
    if name in catalog.ORACLES:
        want = duck.sql(catalog.ORACLES[name])
        assert sorted(df.columns) == sorted(want.columns)
        assert rows(df.columns, got) == rows(want.columns, want.fetchall())
    else:
        assert got


def test_postings_cover_all_documents(spark, tmp_path):
    rows = [(1, "The cat, the CAT", "en", "src1"), (2, "le chat été", "fr", "src1"), (3, "no language cat", None, None), (4, None, "de", "src2"), (5, "", "en", ""), (5, "the cat", "en", "src1")]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").write.parquet(f"{tmp_path}/documents.parquet")
    found = collections.Counter()
    for i, text, lang, source in rows:
        for value, w in ((source, 2.5), (lang, 2.0), (text, 1.0)):
            for t in re.findall(r"[^\W_]+", (value or "").lower()):
                found[t, i] += w
    want = {t: (sum(x == t for x, _ in found), sum(f for (x, _), f in found.items() if x == t)) for t, _ in found}
    got = {r.term: (r.n, r.f) for r in catalog.QUERIES["search_postings_whole"](spark, str(tmp_path)).collect()}
    assert got == want and got["cat"] == (3, 4.0) and "été" in got


def test_fetch_actions_count_all_events(spark, sf):
    bought, failed = set(), collections.Counter()
    for r in spark.read.parquet(f"{sf}/events.parquet").collect():
        failed[r.user_id] += r.event_type == "error"
        if r.event_type == "purchase" and r.value is not None and r.value >= 150:
            bought.add(r.user_id)
    want = {u: "fetched" if u in bought else "permanent" if n >= 14 else "fetch" for u, n in failed.items()}
    got = {r.user_id: r.action for r in catalog.QUERIES["fetch_actions_whole"](spark, sf).collect()}
    assert got == want and set(got.values()) == {"fetched", "permanent", "fetch"}


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_search_plan_reads_only_its_columns(spark, sf):
    plan = catalog.QUERIES["facet_distribution"](spark, sf)._jdf.queryExecution().toString()
    assert "ReadSchema: struct<lang:string,source:string>" in plan
