"""Session settings, the shared folder, staged tables and shipping of the package to the workers."""

from __future__ import annotations

import os
import re
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_SHIPPED: set[str] = set()
_HOMES: set[str] = set()


def get_session(app: str = "quarry", cpus: str = "*", shuffle: int = 8, **conf: str) -> SparkSession:
    """A local session with the settings that the library is tested under."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the input tables; the path may be in any store that Spark reads."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that the driver and all executors share: spark.checkpoint.dir, else the context's own.

    Only in a local session (as in tests) where neither is set a temporary folder is made and set; on a cluster
    the executors would not see it, so there one must be named.
    """
    given = spark.conf.get("spark.checkpoint.dir", None)
    if given:
        return given.rstrip("/")
    context = spark.sparkContext
    held = context._jsc.sc().getCheckpointDir()
    if held.isDefined():
        return held.get().rstrip("/")
    if not re.fullmatch(r"local(\[.*\])?", context.master):
        raise RuntimeError("name a folder that all executors share in spark.checkpoint.dir")
    made = "file://" + tempfile.mkdtemp(prefix="quarry-")
    context.setCheckpointDir(made)
    return made


def scratch(spark: SparkSession, label: str) -> str:
    """A new path below the shared folder, in a folder of the application's own that goes when its driver ends."""
    context = spark.sparkContext
    home = f"{shared_dir(spark)}/quarry/{context.applicationId}"
    if home not in _HOMES:
        where = context._jvm.org.apache.hadoop.fs.Path(home)
        store = where.getFileSystem(context._jsc.hadoopConfiguration())
        store.mkdirs(where)
        store.deleteOnExit(where)
        _HOMES.add(home)
    return f"{home}/{label}-{uuid.uuid4().hex}"


def staged(df: DataFrame, label: str, partition_by: list[str] | None = None) -> DataFrame:
    """Write df below the shared folder and read it back: cuts lineage, survives lost executors."""
    spark = df.sparkSession
    path = scratch(spark, label)
    writer = df.write
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: Bytes (as Spark estimates them) below which a table is dealt to all cores before dear work on its rows.
SPREAD = 1 << 30


def spread(df: DataFrame) -> DataFrame:
    """A small table dealt evenly to all cores: it may be one row group of one file, which one task would read and work through.

    Large tables, whose files give tasks enough, stay as they are."""
    size = int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    return df.repartition(df.sparkSession.sparkContext.defaultParallelism) if size < SPREAD else df


def drop_staged(spark: SparkSession, path: str) -> None:
    """Remove a path that scratch() gave, with the store's own client."""
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


#: Rows of an Arrow batch at most (Spark bounds its bytes): a batch is held several times.
BATCH_ROWS = 2000


def ship(spark: SparkSession) -> None:
    """Give the package to the Python workers once for each context, so that they import it; bound Arrow batches."""
    context = spark.sparkContext
    if int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) > BATCH_ROWS:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    if context.applicationId in _SHIPPED:
        return
    root = Path(__file__).resolve().parent
    where = os.path.realpath(tempfile.mkdtemp(prefix="quarry-ship-"))
    with zipfile.ZipFile(f"{where}/quarry_package.zip", "w", zipfile.ZIP_DEFLATED) as out:
        for path in sorted(root.rglob("*.py")):
            out.write(path, Path(root.name) / path.relative_to(root))
    context.addPyFile(f"{where}/quarry_package.zip")
    _SHIPPED.add(context.applicationId)


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Within it, a finished query's shuffle files go at once: for steps that are written before they are used."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, "false")
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before)


@contextmanager
def written_as_they_come(spark: SparkSession) -> Iterator[None]:
    """Within it, writes to folders do not sort by folder first: for tasks that have rows of few folders, in an order of their own."""
    key = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(key, "0")
    spark.conf.set(key, "8")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def release(spark: SparkSession) -> None:
    """Ask for the shuffle files of finished steps to go: Spark drops them when the driver's
    references are collected, which in a short-lived driver with a large heap may be never."""
    import gc

    gc.collect()
    spark.sparkContext._jvm.System.gc()
