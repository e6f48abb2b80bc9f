"""Stores that are written whole: versions swapped in by name, content-addressed rows, pruning and skipping of equal writes.

A store is a folder with versions and a file CURRENT that names one. A version is written beside the others and becomes
current by one rename, so that readers see the old rows or the new ones, never half. All file operations go through
the store's own client (Hadoop FileSystem), and content is compared by digests of rows.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def _client(spark: SparkSession, path: str):
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


def new_version(home: str) -> str:
    return f"{home}/version-{uuid.uuid4().hex}"


def current(spark: SparkSession, home: str) -> str | None:
    """The path of the current version, None before the first."""
    store, where = _client(spark, f"{home}/CURRENT")
    if not store.exists(where):
        return None
    return f"{home}/{spark.read.text(f'{home}/CURRENT').first()[0]}"


def swap(spark: SparkSession, home: str, path: str) -> None:
    """Make a written version current; versions before the last one are removed."""
    before = current(spark, home)
    store, where = _client(spark, home)
    jvm = spark.sparkContext._jvm
    fresh = jvm.org.apache.hadoop.fs.Path(f"{home}/.next-{uuid.uuid4().hex}")
    out = store.create(fresh, True)
    out.write(bytearray(path.rpartition("/")[2].encode()))
    out.close()
    named = jvm.org.apache.hadoop.fs.Path(f"{home}/CURRENT")
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(where.toUri(), spark.sparkContext._jsc.hadoopConfiguration())
    overwrite = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    overwrite[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    context.rename(fresh, named, overwrite)
    held = {x.rpartition("/")[2] for x in (path, before) if x}
    for f in store.listStatus(where):
        name = f.getPath().getName()
        if name.startswith("version-") and name not in held:
            store.delete(f.getPath(), True)


def remove_but(spark: SparkSession, home: str, prefix: str, named: set[str]) -> None:
    """Remove the folders of a store whose names begin with prefix, but for the named ones."""
    store, where = _client(spark, home)
    for f in store.listStatus(where):
        name = f.getPath().getName()
        if name.startswith(prefix) and name not in named:
            store.delete(f.getPath(), True)


def digest_of(rows: DataFrame) -> str:
    """One digest of a frame's rows in any order: sums of two row hashes and the count, map-side combined. Null differs from empty."""
    row = F.to_json(F.struct(*rows.columns), {"ignoreNullFields": "false"})
    wide = lambda seed: F.sum(F.xxhash64(row, F.lit(seed)).cast("decimal(38,0)"))
    one = rows.agg(F.count("*").alias("n"), wide(1).alias("a"), wide(2).alias("b")).first()
    return f"{one['n']}:{one['a']}:{one['b']}"


def replace_table(rows: DataFrame, home: str) -> bool:
    """Write rows as the store's new version unless the current one holds the same rows; whether it was written."""
    spark = rows.sparkSession
    path = new_version(home)
    before = current(spark, home)
    rows.write.parquet(path)
    if before is not None:
        old = spark.read.parquet(before)
        if old.columns == rows.columns and digest_of(old) == digest_of(spark.read.schema(rows.schema).parquet(path)):
            store, where = _client(spark, path)
            store.delete(where, True)
            return False
    swap(spark, home, path)
    return True


def read_table(spark: SparkSession, home: str) -> DataFrame:
    return spark.read.parquet(current(spark, home))


def address(content: Column, extension: str) -> Column:
    return F.concat(F.sha2(content, 256), F.lit(f".{extension}"))


def put_content(rows: DataFrame, content: str, extension: str, stored: DataFrame | None = None) -> DataFrame:
    """(name, content) of contents that the store does not have, each once: written once under the digest of its bytes."""
    fresh = rows.select(F.col(content).cast("binary").alias("content")).where("content IS NOT NULL").groupBy(address(F.col("content"), extension).alias("name")).agg(F.first("content").alias("content"))
    return fresh if stored is None else fresh.join(stored.select("name"), "name", "left_anti")


def unreferenced(stored: DataFrame, texts: DataFrame, text: str) -> DataFrame:
    """Stored names whose 64-digit digest no text mentions."""
    told = texts.select(F.explode(F.regexp_extract_all(F.lower(text), F.lit(r"\b([0-9a-f]{64})\b"), F.lit(1))).alias("digest")).distinct()
    return stored.select("name", F.substring("name", 1, 64).alias("digest")).join(told, "digest", "left_anti").select("name")


def prune(stored: DataFrame, kept: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """Rows that stay and rows that go: a row goes where its key is not among the kept ones."""
    return stored.join(kept.select(key).distinct(), key, "left_semi"), stored.join(kept.select(key).distinct(), key, "left_anti")


def upsert(stored: DataFrame, fresh: DataFrame, key: str, at: str) -> DataFrame:
    """The newest row of each key; a fresh row wins over a stored one of the same time. Aggregated, no window of a key's rows."""
    both = stored.withColumn("_fresh", F.lit(0)).unionByName(fresh.select(*stored.columns).withColumn("_fresh", F.lit(1)))
    rest = [c for c in stored.columns if c != key]
    newest = both.groupBy(key).agg(F.max(F.struct(at, "_fresh", *[c for c in rest if c != at])).alias("r"))
    return newest.select(key, *[F.col(f"r.{c}").alias(c) for c in rest]).select(*stored.columns)
