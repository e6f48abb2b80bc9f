"""Incremental state over micro-batches: windowed and session counts, and the latest row of each key in buckets."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from quarry.operators.versions import latest_state

#: Buckets of keys of an upserted state; a state of many rows asks for more.
BUCKETS = 64


def windowed_counts(events: DataFrame, at: str, kind: str, width: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """Counts by tumbling window and kind; the watermark bounds the state on a stream."""
    if events.isStreaming:
        events = events.withWatermark(at, late)
    return events.groupBy(F.window(at, width).alias("w"), kind).agg(F.count("*").alias("n")).select(F.col("w.start").alias("start"), kind, "n")


def sessions(events: DataFrame, key: str, at: str, gap: str = "30 minutes", late: str = "2 hours", value: str | None = None) -> DataFrame:
    """(key, start, stop, events, and the sum of a value) of each run of a key's events with less than gap between two: the same rows on a batch
    and, once the watermark has passed them, on a stream. Rows without a key or a time belong to none.

    On a stream events that come later than the watermark are left out, and counted by late_rows()."""
    rows = events.where(F.col(key).isNotNull() & F.col(at).isNotNull())
    if events.isStreaming:
        rows = rows.withWatermark(at, late)
    sums = [F.round(F.sum(value), 6).alias(value)] if value else []
    found = rows.groupBy(F.session_window(at, gap).alias("w"), key).agg(F.count("*").alias("events"), *sums)
    return found.select(key, F.col("w.start").alias("start"), F.col("w.end").alias("stop"), "events", *([value] if value else []))


def late_rows(query: StreamingQuery) -> int:
    """Rows that the query's state operators left out as too late, over the progress that the query still holds."""
    return sum(op.numRowsDroppedByWatermark for p in query.recentProgress for op in p.stateOperators)


def _store(spark: SparkSession, path: str):
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


def _numbers(spark: SparkSession, path: str, prefix: str) -> list[int]:
    """The numbers of a folder's entries of a prefix, rising."""
    store, where = _store(spark, path)
    names = [f.getPath().getName() for f in store.listStatus(where)] if store.exists(where) else []
    return sorted(int(n.removeprefix(prefix)) for n in names if n.startswith(prefix))


def _newest(spark: SparkSession, path: str, buckets: list[int], before: int) -> list[str]:
    """The folders of the buckets' newest versions that were finished by batches below ``before``."""
    out = []
    for b in buckets:
        held = [n for n in _numbers(spark, f"{path}/bucket={b}", "version=") if n < before]
        out += [f"{path}/bucket={b}/version={held[-1]}"] if held else []
    return out


def merge_batch(batch: DataFrame, number: int, path: str, key: str, at: str, values: list[str], buckets: int = BUCKETS) -> list[int]:
    """Merge one micro-batch into the state; returns the buckets that were read and written: those of the batch's keys.

    A bucket's version goes by the batch's number, and readers count it only when the batch is marked as finished: a repeated
    batch writes the same versions again. Versions before a bucket's last two go."""
    spark = batch.sparkSession
    rows = batch.select(key, at, *values).withColumn("bucket", F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")).persist()
    touched = sorted(r["bucket"] for r in rows.select("bucket").distinct().collect())  # at most buckets numbers
    old = _newest(spark, path, touched, number)
    if old:
        held = spark.read.schema(batch.select(key, at, *values).schema).parquet(*old).withColumn("bucket", F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int"))
        both = rows.unionByName(held)
    else:
        both = rows
    if touched:
        merged = latest_state(both, key, at, values).withColumn("bucket", F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")).withColumn("version", F.lit(number))
        merged.repartition(len(touched), "bucket").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("bucket", "version").parquet(path)
    rows.unpersist()
    store, where = _store(spark, f"{path}/_finished/batch={number}")
    store.create(where, True).close()
    for b in touched:
        for n in [n for n in _numbers(spark, f"{path}/bucket={b}", "version=") if n <= number][:-2]:
            store.delete(_store(spark, f"{path}/bucket={b}/version={n}")[1], True)
    return touched


def upsert_latest(stream: DataFrame, path: str, checkpoint: str, key: str, at: str, values: list[str], buckets: int = BUCKETS) -> StreamingQuery:
    """Merge each micro-batch into a state of the latest row of each key, in buckets by the key's hash: a batch rewrites only those that its keys are in."""

    def merge(batch: DataFrame, number: int) -> None:
        merge_batch(batch, number, path, key, at, values, buckets)

    return stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def newest_state(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The state after the last finished batch; no rows before the first."""
    done = _numbers(spark, f"{path}/_finished", "batch=")
    found = _newest(spark, path, _numbers(spark, path, "bucket="), done[-1] + 1) if done else []
    return spark.read.schema(schema).parquet(*found) if found else spark.createDataFrame([], schema)
