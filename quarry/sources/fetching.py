"""Fetching many addresses: a Python data source with a partition for each group of hosts, and a resumable ingest over it.

A list of addresses is staged in folders by the hash of their host, so that a host belongs to one partition, whose task keeps
to the least wait between two requests to it and serves other hosts meanwhile. Answers come as rows; a failure is a row with
its status. The list is read in the task from the shared folder by pyarrow; nothing passes through the driver but the names of the folders.

ingest() keeps what became of each document (state) and payloads by their digest (content) below a home folder. It works in
portions; a portion's state is swapped in after its content was written, so that a run that is stopped loses at most one portion,
and the next run asks only for what is neither fetched nor given up.
"""

from __future__ import annotations

import heapq
import time
from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from quarry.functions.text import url_host
from quarry.operators import stores
from quarry.session import scratch, ship
from quarry.sources.http import Page, get_page

#: Groups of hosts, seconds between two requests to a host, attempts over all runs after which a document is given up.
GROUPS, LEAST_WAIT, MOST_ATTEMPTS = 64, 0.5, 3
ROW = "doc_id string, url string, status int, content binary, seconds double"
STATE = "doc_id string, url string, status string, attempts int, code int, digest string, bytes long"


class HostGroup(InputPartition):
    def __init__(self, path: str):
        self.path = path


def served(rows: list[tuple[str, str, str]], get: Callable[[str], Page], wait: float, now: Callable[[], float] = time.monotonic, sleep: Callable[[float], None] = time.sleep) -> Iterator[tuple]:
    """(doc_id, url, status, content, seconds) of rows (doc_id, url, host): the host that may be asked first comes first."""
    by: dict[str, list[tuple[str, str]]] = {}
    for doc_id, url, host in rows:
        by.setdefault(host, []).append((doc_id, url))
    ready = [(0.0, host) for host in sorted(by)]
    while ready:
        at, host = heapq.heappop(ready)
        if at > now():
            sleep(at - now())
        began = now()
        doc_id, url = by[host].pop(0)
        page = get(url)
        yield doc_id, url, page.status, page.content if page.status == 200 else None, round(now() - began, 3)
        if by[host]:
            heapq.heappush(ready, (began + wait, host))


class PageReader(DataSourceReader):
    def __init__(self, options: dict):
        self.list, self.wait, self.timeout = options["list"], float(options.get("wait", LEAST_WAIT)), float(options.get("timeout", 30))

    def partitions(self) -> list[HostGroup]:
        from pyarrow import fs

        store, where = fs.FileSystem.from_uri(self.list)
        found = store.get_file_info(fs.FileSelector(where, recursive=False))
        return [HostGroup(f.path) for f in sorted(found, key=lambda f: f.path) if f.base_name.startswith("group=")]

    def read(self, partition: HostGroup | None) -> Iterator[tuple]:
        import pyarrow.parquet as pq
        from pyarrow import fs

        if partition is None:  # there are no addresses
            return
        store, _ = fs.FileSystem.from_uri(self.list)
        for f in sorted(store.get_file_info(fs.FileSelector(partition.path)), key=lambda f: f.path):
            if f.base_name.endswith(".parquet"):
                rows = pq.read_table(f.path, filesystem=store, columns=["doc_id", "url", "host"], partitioning=None).to_pylist()
                yield from served([(r["doc_id"], r["url"], r["host"]) for r in rows], lambda url: get_page(url, timeout=self.timeout), self.wait)


class PageSource(DataSource):
    """Format quarry_pages; options: list (folder of staged addresses), wait, timeout."""

    @classmethod
    def name(cls) -> str:
        return "quarry_pages"

    def schema(self) -> str:
        return ROW

    def reader(self, schema) -> PageReader:
        return PageReader(self.options)


def fetch(targets: DataFrame, wait: float = LEAST_WAIT, groups: int = GROUPS, timeout: float = 30.0) -> DataFrame:
    """targets(doc_id, url) -> doc_id, url, status, content, seconds. Null addresses are left out. Each evaluation asks anew: stage it."""
    spark = targets.sparkSession
    ship(spark)
    path = scratch(spark, "addresses")
    host = F.coalesce(url_host(F.col("url")), F.lit(""))
    rows = targets.where("url IS NOT NULL").select(F.col("doc_id").cast("string").alias("doc_id"), "url", host.alias("host"), F.pmod(F.xxhash64(host), F.lit(groups)).alias("group"))
    rows.repartition(groups, "group").write.partitionBy("group").parquet(path)
    spark.dataSource.register(PageSource)
    return spark.read.format("quarry_pages").option("list", path).option("wait", str(wait)).option("timeout", str(timeout)).load()


def next_status(prior: Column, attempts: Column, content: Column, magic: bytes | None, most: int = MOST_ATTEMPTS) -> Column:
    """What a document becomes after an answer: no payload fails, for good after most attempts; a payload without the wanted beginning is bad content."""
    good = F.lit(True) if magic is None else F.substring(content, 1, len(magic)) == F.lit(bytearray(magic))
    return F.when(prior.isin("fetched", "permanent_missing"), prior).when(content.isNull(), F.when(attempts >= most, "permanent_missing").otherwise("failed")).otherwise(F.when(good, "fetched").otherwise("bad_content"))


def state(spark: SparkSession, home: str) -> DataFrame:
    """What became of each document so far."""
    path = stores.current(spark, f"{home}/state")
    return spark.createDataFrame([], STATE) if path is None else spark.read.schema(STATE).parquet(path)


def contents(spark: SparkSession, home: str) -> DataFrame:
    """(digest, content) of all payloads, each once."""
    return spark.read.schema("digest string, content binary").option("recursiveFileLookup", "true").parquet(f"{home}/content")


def ingest(targets: DataFrame, home: str, portions: int = 8, magic: bytes | None = None, refetch: bool = False, **how) -> DataFrame:
    """Fetch targets(doc_id, url; distinct ids) that are not done, and return the state of all documents.

    Done are documents that were fetched or given up (with refetch, none). Documents of the state that are not among the targets stay as they are."""
    spark = targets.sparkSession
    todo = targets.select(F.col("doc_id").cast("string").alias("doc_id"), "url")
    for portion in range(portions):
        held = state(spark, home)
        done = held.where(F.col("status").isin("fetched", "permanent_missing", "bad_content"))
        mine = todo.where(F.pmod(F.xxhash64(F.coalesce(url_host("url"), F.lit("")), F.lit("portion")), F.lit(portions)) == portion)
        mine = mine if refetch else mine.join(done.select("doc_id"), "doc_id", "left_anti")
        got_path = scratch(spark, "answers")
        fetch(mine, **how).write.parquet(got_path)  # one evaluation: an address is asked once
        got = spark.read.schema(ROW).parquet(got_path).withColumn("digest", F.sha2("content", 256))
        if got.isEmpty():
            continue
        fresh = got.where("content IS NOT NULL").groupBy("digest").agg(F.first("content").alias("content"))
        fresh = fresh.join(held.where("digest IS NOT NULL").select("digest").distinct(), "digest", "left_anti")
        fresh.write.mode("append").parquet(f"{home}/content")
        before = held.select("doc_id", F.col("status").alias("prior"), "attempts")
        prior = F.lit(None).cast("string") if refetch else F.col("prior")
        tried = got.join(before, "doc_id", "left").withColumn("attempts", F.coalesce("attempts", F.lit(0)) + 1)
        told = tried.select("doc_id", "url", next_status(prior, F.col("attempts"), F.col("content"), magic).alias("status"), "attempts", F.col("status").alias("code"), "digest", F.length("content").cast("long").alias("bytes"))
        now = held.join(got.select("doc_id"), "doc_id", "left_anti").unionByName(told)
        path = stores.new_version(f"{home}/state")
        now.write.parquet(path)
        stores.swap(spark, f"{home}/state", path)
    return state(spark, home)
