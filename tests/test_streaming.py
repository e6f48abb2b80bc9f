"""Streams against the batch results: sessions with late rows, and the bucketed state."""

import datetime
import os

from quarry.session import scratch
from quarry.streaming import incremental

T0 = datetime.datetime(2024, 1, 1)
SCHEMA = "user long, at timestamp, value double, start string"


def at(minutes):
    return T0 + datetime.timedelta(minutes=minutes)


def files(spark, batches, path):
    """One file a batch, in order of their names' times."""
    for k, rows in enumerate(batches):
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(path)
        for f in os.listdir(path):
            if f.endswith(".parquet") and not f.startswith("b"):
                os.rename(f"{path}/{f}", f"{path}/b{k}.parquet")
                os.utime(f"{path}/b{k}.parquet", (1_700_000_000 + k, 1_700_000_000 + k))
    return spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).option("pathGlobFilter", "b*.parquet").parquet(path)


def test_sessions_out_of_order(spark, tmp_path):
    row = lambda u, m, v=1.0: (u, at(m), v, "clash")
    batches = [
        [row(1, 0), row(2, 5), row(None, 6), (3, None, 1.0, "x")],
        [row(1, 40), row(1, 20)],  # the second of these joins the first two
        [row(2, 100), row(2, 3)],  # out of order, but not late
        [row(9, 400)],
        [row(9, 410)],  # rows are late by the watermark that the batch before the last one left
        [row(1, 30, 5.0), row(7, 390)],  # the first is behind the watermark (400 - 120)
        [row(9, 5000)],
        [row(9, 9999)],
    ]
    stream = files(spark, batches, str(tmp_path / "in"))
    found = incremental.sessions(stream, "user", "at", "30 minutes", "2 hours", "value")
    query = found.writeStream.format("memory").queryName("found_sessions").outputMode("append").option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    query.awaitTermination()
    in_time = [r for b in batches for r in b if r[:3] != (1, at(30), 5.0)]
    want = incremental.sessions(spark.createDataFrame(in_time, SCHEMA), "user", "at", "30 minutes", value="value").where("start < timestamp'2024-01-07'")
    got = sorted(map(tuple, spark.table("found_sessions").collect()))
    assert got == sorted(map(tuple, want.collect())) and [(g[0], g[3]) for g in got] == [(1, 3), (2, 2), (2, 1), (7, 1), (9, 2), (9, 1)]
    assert incremental.late_rows(query) == 1


def test_a_batch_rewrites_its_own_buckets(spark):
    path = scratch(spark, "buckets")
    schema = "user long, at timestamp, value double"
    make = lambda rows: spark.createDataFrame([(u, at(m), float(m)) for u, m in rows], schema)
    first = incremental.merge_batch(make([(u, 10) for u in range(200)]), 0, path, "user", "at", ["value"], 16)
    assert first == list(range(16))
    second = incremental.merge_batch(make([(5, 30), (6, 1)]), 1, path, "user", "at", ["value"], 16)
    assert len(second) <= 2
    local = path.removeprefix("file:")
    assert sorted(len([v for v in os.listdir(f"{local}/bucket={b}") if v.startswith("version=")]) for b in range(16)) == [1] * (16 - len(second)) + [2] * len(second)
    kind = make([]).schema
    held = lambda: {r.user: r.value for r in incremental.newest_state(spark, path, kind).collect()}
    want = {u: 30.0 if u == 5 else 10.0 for u in range(200)}
    assert held() == want
    # A batch that was stopped after its rows were written does not count, and its repetition changes nothing else.
    incremental.merge_batch(make([(7, 50)]), 2, path, "user", "at", ["value"], 16)
    os.remove(f"{local}/_finished/batch=2")
    assert held() == want
    for _ in range(2):
        incremental.merge_batch(make([(7, 50)]), 2, path, "user", "at", ["value"], 16)
        assert held() == want | {7: 50.0}
    incremental.merge_batch(make([]), 3, path, "user", "at", ["value"], 16)
    for n in range(4, 8):
        incremental.merge_batch(make([(7, 50 + n)]), n, path, "user", "at", ["value"], 16)
    assert held()[7] == 57.0 and len(os.listdir(f"{local}/{next(b for b in os.listdir(local) if b.startswith('bucket=') and f'version=7' in os.listdir(f'{local}/{b}'))}")) <= 3
    assert incremental.newest_state(spark, scratch(spark, "none"), kind).count() == 0
