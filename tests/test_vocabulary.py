import sqlite3

import duckdb
import pytest
from pyspark.sql import functions as F

from quarry.operators import bodies, vocabulary
from quarry.plans import library_queries
from quarry.sources.sqlite import sqlite_table

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ["candidate_quality", "mention_forms", "form_totals", "seeded_profiles", "code_fences"])
def test_against_sql(spark, name):
    db = duckdb.connect()
    for t in ("part", "nation", "lineitem", "customer", "supplier", "region", "orders"):
        db.sql(f"CREATE VIEW {t} AS FROM '{SF}/{t}.parquet'")
    got = library_queries.QUERIES[name](spark, SF)
    columns = sorted(got.columns)
    want = db.sql(library_queries.ORACLES[name])
    assert sorted(want.columns) == columns
    rows = sorted(map(repr, map(tuple, got.select(*columns).collect())))
    assert rows and rows == sorted(map(repr, want.select(", ".join(columns)).fetchall()))


def test_odd_rows(spark):
    none = spark.createDataFrame([(None, None), ("file", None), ("x", "1")], "type string, surface string")
    known = spark.createDataFrame([("file", "200", "NEW THING"), ("file", "200", None)], "type string, surface string, name string")
    got = vocabulary.candidate_quality(none, known, "file", ["file"]).collect()
    assert sorted((r.recognised, r.reach) for r in got) == [("not-a-file", "inert-not-a-real-file"), ("unchecked", "inert-no-landing-place"), ("unchecked", "inert-no-landing-place")]
    assert vocabulary.candidate_quality(none.limit(0), known, "file", ["file"]).count() == 0
    text = spark.createDataFrame([("the ODD (x) file is", True), ("files: odd (x)", True), ("odd (x) (#7)", True), ("odd (x) alone", False), ("odd x file", False)], "t string, want boolean")
    got = text.select(vocabulary.in_file_context(F.col("t"), F.lit("odd (x)"), F.lit("7")).alias("got"), "want").collect()
    assert all(r.got == r.want for r in got)


def test_fence_code():
    body = "Intro\n**S ^A(1)=\"x\"**\n\n\n\\>D ^B(\\$J)\nthe **$ORDER** function\nIf the call (x)\n**^GLOB $X**\n```\nS X=1\n```\nW $P(X,1)"
    new, told = bodies.fence_code(body)
    code = '```console\nS ^A(1)="x"\n>D ^B($J)\n```'
    assert new == f"Intro\n\n{code}\n\nthe **$ORDER** function\nIf the call (x)\n{bodies.REVIEW}\n**^GLOB $X**\n```\nS X=1\n```\n\n```mumps\nW $P(X,1)\n```\n"
    assert (told.blocks, told.consoles, told.unescaped, told.review) == (2, 1, 1, 1)
    for plain in ("", "prose", "```\nS X=1\n```"):
        assert bodies.fence_code(plain)[0] == plain


def test_sqlite(spark, tmp_path):
    path = tmp_path / "a b?.db"
    db = sqlite3.connect(path)
    db.execute('CREATE TABLE "odd ""t" (a INTEGER, b VARCHAR(9), "c d" REAL, e BLOB)')
    rows = [(i, None if i % 5 == 0 else f"é{i}", i / 3, bytes([i % 256])) for i in range(2500)]
    db.executemany('INSERT INTO "odd ""t" VALUES (?, ?, ?, ?)', rows)
    db.execute('DELETE FROM "odd ""t" WHERE a BETWEEN 700 AND 1900')
    db.execute("CREATE TABLE void (a INT)")
    db.commit()
    db.close()
    got = sqlite_table(spark, str(path), 'odd "t', 500)
    assert got.dtypes == [("a", "bigint"), ("b", "string"), ("c d", "double"), ("e", "binary")]
    assert sorted(tuple(r[:3]) + (bytes(r[3]),) for r in got.collect()) == [r for r in rows if not 700 <= r[0] <= 1900]
    assert sqlite_table(spark, str(path), "void").count() == 0
    with pytest.raises(ValueError):
        sqlite_table(spark, str(path), "none")
