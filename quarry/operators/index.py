"""A search index of immutable segments: built once, then extended by what changed and merged by size.

An index is a folder. A segment holds the chunks that were written together: ``postings`` (term, key, at: the occurrences of a term
in a chunk as (field number, position)), ``terms`` (in how many of its chunks a term stands), ``chunks`` (key, length,
digest of the row, facets and shown columns). A version names the segments that count, has the statistics over all of them, and lists
the dead: keys whose chunk in a segment was replaced or removed. Versions are swapped by name, so that readers see the
old index or the new one.

An update compares digests of the given rows with those in ``chunks``: rows that are as they were are carried over untouched,
changed and new ones make one new segment, and the old places of changed and gone ones are dead. No posting is read. Merging reads
the postings of segments of about one size, or mostly dead ones, and writes them together without their dead.

Postings are grouped by term, a batch of chunks at a time, and travel as blocks, the chunks of a batch that hold a term; one shuffle
places them: folders (shards) by the term's hash, as many as the tokens ask for, sorted by term. An occurrence is stored as one number. Terms that a sample of chunks shows to be common are split by key where they would pass SPLIT rows.
The sample decides only where rows lie.
"""

from __future__ import annotations

import itertools
import json
import math
import uuid
import zlib
from collections.abc import Iterator, Mapping
from dataclasses import asdict, dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as t

from quarry.operators import stores
from quarry.session import ship, spread, staged, written_as_they_come

TERM = r"([\p{L}\p{N}]+)"
SCHEMA_VERSION = "1"
#: Tokens of a shard, least and most shards of a segment.
SHARD_TOKENS, LEAST_SHARDS, MOST_SHARDS = 4_000_000, 8, 65536
#: Postings of a common term in one file; chunks that show which terms are common, and the share that makes one.
SPLIT, SAMPLE, COMMON = 1_000_000, 10_000, 0.01
#: Segments of about one size that are merged, and the share of dead chunks from which a segment is rewritten alone.
FAN, ROTTEN = 8, 0.5
#: Tokens that are grouped in one go.
GROUPED = 1_000_000


def terms(c: Column) -> Column:
    return F.regexp_extract_all(F.lower(F.coalesce(c, F.lit(""))), F.lit(TERM), F.lit(1))


def shard_of(term: str, shards: int) -> int:
    return zlib.crc32(term.encode()) % shards


def _marked(name: str, number: int) -> Column:
    return F.transform(terms(F.col(name)), lambda t, i: F.struct(t.alias("term"), F.lit(number).cast("tinyint").alias("f"), i.alias("p")))


def grouped(fields: Mapping[str, float]) -> Column:
    """The occurrences of a row's fields as array(term, at): sorted, and cut where the term changes."""
    tokens = F.sort_array(F.concat(*(_marked(name, k) for k, name in enumerate(fields))))

    def cut(s: Column) -> Column:
        begins = F.filter(F.sequence(F.lit(0), F.size(s) - 1), lambda i: (i == 0) | (F.get(s, i)["term"] != F.get(s, i - 1)["term"]))

        def parts(b: Column) -> Column:
            end = lambda k: F.coalesce(F.get(b, k + 1), F.size(s))
            return F.transform(b, lambda i, k: F.struct(F.get(s, i)["term"].alias("term"), F.transform(F.slice(s, i + 1, end(k) - i), lambda x: F.struct(x["f"].alias("f"), x["p"].alias("p"))).alias("at")))

        return F.transform(F.array(begins), parts)[0]

    none = F.array().cast("array<struct<term:string,at:array<struct<f:tinyint,p:int>>>>")
    return F.transform(F.array(tokens), lambda s: F.when(F.size(s) > 0, cut(s)).otherwise(none))[0]


def _blocks_of(key: pa.Array, tokens: list[pa.ListArray], parts: Mapping[str, int]) -> pa.RecordBatch:
    """(term, part, keys, at) of some chunks by the tokens of their fields: a stable sort by term, part and chunk leaves occurrences in order."""
    rows, places = [], []
    for number, field in enumerate(tokens):
        times = np.diff(field.offsets.to_numpy())
        rows.append(np.repeat(np.arange(len(field)), times))
        places.append((number << 32) + np.arange(len(rows[-1])) - np.repeat(np.cumsum(times) - times, times))
    coded = pa.concat_arrays([field.flatten() for field in tokens]).dictionary_encode()
    code, row = coded.indices.to_numpy().astype(np.int64), np.concatenate(rows)
    n = max(1, len(key))
    split = np.array([parts.get(x, 1) for x in coded.dictionary.to_pylist()], np.int64) if parts else np.ones(len(coded.dictionary), np.int64)
    block = (np.cumsum(split) - split)[code] + row % split[code]
    told = block * n + row
    order = np.argsort(told, kind="stable")
    told = told[order]
    first = np.flatnonzero(np.diff(told, prepend=-1))  # of a chunk's occurrences of a term
    block, row = np.divmod(told[first], n)
    begin = np.flatnonzero(np.diff(block, prepend=-1))  # of a block's chunks
    ends = pa.array(np.append(begin, len(first)), pa.int32())
    at = pa.ListArray.from_arrays(pa.array(np.append(first, len(told)), pa.int32()), pa.array(np.concatenate(places)[order]))
    code = code[order[first[begin]]]
    columns = [coded.dictionary.take(pa.array(code)), pa.array((row[begin] % split[code]).astype(np.int32)), pa.ListArray.from_arrays(ends, key.take(pa.array(row))), pa.ListArray.from_arrays(ends, at)]
    return pa.RecordBatch.from_arrays(columns, ["term", "part", "keys", "at"])


def _blocks(chunks: DataFrame, key: str, fields: Mapping[str, float], parts: Mapping[str, int]) -> DataFrame:
    """(term, part, keys, at) of chunks, at packed; at most about GROUPED tokens are grouped at a time. Terms in parts are dealt to so many."""
    ship(chunks.sparkSession)
    most, told = GROUPED, chunks.sparkSession.sparkContext.broadcast(dict(parts))

    def group(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ends = sum(np.diff(c.offsets.to_numpy()) for c in batch.columns[1:]).cumsum(dtype=np.int64)
            cuts = [0, *(np.flatnonzero(np.diff(ends // most)) + 1).tolist(), len(ends)]
            for a, b in zip(cuts, cuts[1:], strict=False):
                if b > a:
                    some = batch.slice(a, b - a)
                    yield _blocks_of(some.column(0), some.columns[1:], told.value)

    keys = t.ArrayType(chunks.schema[key].dataType, False)
    made = t.StructType().add("term", t.StringType()).add("part", t.IntegerType()).add("keys", keys).add("at", t.ArrayType(t.ArrayType(t.LongType(), False), False))
    return chunks.select(key, *[terms(F.col(c)).alias(f"f{k}") for k, c in enumerate(fields)]).mapInArrow(group, made)


def _unpacked(at: Column) -> Column:
    return F.transform(at, lambda x: F.struct(F.shiftright(x, 32).cast("tinyint").alias("f"), x.bitwiseAND(F.lit(2**32 - 1)).cast("int").alias("p")))


def _schema(table: str, key: str, kind: str) -> str:
    """Of the tables that are dealt to folders: one without rows has no file to tell it."""
    return {"postings": f"term string, `{key}` {kind}, at array<bigint>, shard int", "terms": "term string, n long, times long, shard int"}[table]


@dataclass(frozen=True)
class Segment:
    name: str
    shards: int
    chunks: int
    tokens: int


def shards_for(tokens: int, a_shard: int = SHARD_TOKENS) -> int:
    return min(MOST_SHARDS, max(LEAST_SHARDS, 1 << max(0, math.ceil(tokens / a_shard) - 1).bit_length()))


def _sampled(chunks: DataFrame, n: int) -> DataFrame:
    """About SAMPLE of n chunks, drawn where they are: a limit would take so many from each task to a single one."""
    return chunks.sample(SAMPLE / n, seed=7) if n > SAMPLE else chunks


def _common(worded: DataFrame, key: str, chunks: int, tokens: int, split: int, a_shard: int = SHARD_TOKENS) -> DataFrame | None:
    """(term, parts) of the terms that take more than one file, by their chunks or their occurrences in a sample: at most 1 / COMMON times the terms of a chunk."""
    if chunks <= split and tokens <= a_shard:
        return None
    sample = staged(worded.select(key, F.transform("words", lambda x: F.struct(x["term"].alias("term"), F.size(x["at"]).alias("times"))).alias("words")), "index-sample")
    n = sample.count()
    seen = sample.select(F.explode("words").alias("x")).groupBy("x.term").agg(F.count("*").alias("n"), F.sum("x.times").alias("times")).where(F.col("n") >= max(2, COMMON * n))
    parts = F.greatest(F.ceil(F.col("n") / n * chunks / split), F.ceil(F.col("times") / n * chunks / a_shard)).cast("int")
    return seen.select("term", parts.alias("parts")).where("parts > 1")


def _parts(common: DataFrame | None) -> dict[str, int]:
    return {} if common is None else {r["term"]: r["parts"] for r in common.collect()}  # bounded, see _common


def _write_postings(blocks: DataFrame, key: str, path: str, shards: int, parts: Mapping[str, int]) -> None:
    """blocks(term, part, keys, at), at packed, as rows (term, key, at) below path, with the counts of terms."""
    spark = blocks.sparkSession
    placed = blocks.withColumn("shard", (F.crc32(F.col("term").cast("binary")) % shards).cast("int"))
    # Tasks are named, one for each shard and each part of a common term: by hashes some would get several and others none.
    files, task = shards, F.col("shard")
    if parts:
        first = dict(zip(sorted(parts), itertools.accumulate((parts[x] for x in sorted(parts)), initial=shards), strict=False))
        files += sum(parts.values())
        placed = placed.join(F.broadcast(spark.createDataFrame(list(first.items()), "term string, first int")), "term", "left")  # bounded, see _common
        task = F.coalesce(F.col("first") + F.col("part"), F.col("shard"))
    placed = placed.select("term", "keys", "at", "shard", task.alias("task")).repartitionById(files, "task").sortWithinPartitions("term")
    rows = placed.select("term", "keys", "shard", F.posexplode("at").alias("_i", "at")).select("term", F.get("keys", F.col("_i")).alias(key), "at", "shard")
    with written_as_they_come(spark):  # a task has rows of one shard, by term
        rows.write.partitionBy("shard").parquet(f"{path}/postings")
    stored = spark.read.schema(_schema("postings", key, rows.schema[key].dataType.simpleString())).parquet(f"{path}/postings")
    counted = stored.groupBy("shard", "term").agg(F.count("*").alias("n"), F.sum(F.size("at")).alias("times"))
    counted.repartition(shards, "shard").sortWithinPartitions("shard", "term").write.partitionBy("shard").parquet(f"{path}/terms")


def _digest(chunks: DataFrame, keep: list[str]) -> Column:
    return F.md5(F.to_json(F.struct(*[F.col(c).cast("string").alias(c) for c in sorted(keep)]), {"ignoreNullFields": "false"}))


def _write_segment(chunks: DataFrame, key: str, fields: Mapping[str, float], home: str, keep: list[str], split: int = SPLIT) -> Segment:
    """chunks, with their digest in ``mark``, as a segment below home."""
    spark = chunks.sparkSession
    name = f"segment-{uuid.uuid4().hex}"
    path = f"{home}/{name}"
    chunks = spread(chunks)
    size = sum((F.size(terms(F.col(c))) for c in fields), F.lit(0)).cast("long")
    chunks.select(key, size.alias("d"), "mark", *keep).write.parquet(f"{path}/chunks")
    one = spark.read.parquet(f"{path}/chunks").agg(F.count("*").alias("n"), F.coalesce(F.sum("d"), F.lit(0)).alias("tokens")).first()
    segment = Segment(name, shards_for(one["tokens"]), one["n"], one["tokens"])
    sample = _sampled(chunks, segment.chunks).select(key, grouped(fields).alias("words"))
    parts = _parts(_common(sample, key, segment.chunks, segment.tokens, split))
    _write_postings(_blocks(chunks, key, fields, parts), key, path, segment.shards, parts)
    return segment


class Index:
    """A version of an index, for reading."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path, self.home = spark, path, path.rpartition("/")[0]
        meta = spark.read.parquet(f"{path}/meta").first()
        self.key, self.fields, self.n, self.avgdl, self.dead_rows = meta["key"], json.loads(meta["fields"]), meta["n"], meta["avgdl"], meta["dead"]
        self.kind = spark.read.parquet(f"{path}/dead").schema[self.key].dataType.simpleString()
        self.kept, self.segments = json.loads(meta["kept"]), [Segment(**s) for s in json.loads(meta["segments"])]

    def dead(self) -> DataFrame:
        """(segment, key, d) of chunks that count no more."""
        return self.spark.read.parquet(f"{self.path}/dead")

    def _live(self, rows: DataFrame) -> DataFrame:
        return rows.join(self.dead().select("segment", self.key), ["segment", self.key], "left_anti") if self.dead_rows else rows

    def _read(self, table: str, wanted: list[str] | None, segments: list[Segment] | None = None) -> DataFrame:
        """Rows of the segments' tables with the segment's name; of the wanted terms their folders only, and within these by pushed filters."""
        out = None
        for s in self.segments if segments is None else segments:
            reader = self.spark.read if table == "chunks" else self.spark.read.schema(_schema(table, self.key, self.kind))
            rows = reader.parquet(f"{self.home}/{s.name}/{table}")
            if wanted is not None:
                rows = rows.where(F.col("shard").isin(sorted({shard_of(t, s.shards) for t in wanted})) & F.col("term").isin(wanted))
            rows = rows.drop("shard").withColumn("segment", F.lit(s.name))
            out = rows if out is None else out.unionByName(rows)
        return out

    def postings(self, wanted: list[str] | None = None) -> DataFrame:
        """(term, key, at) of the chunks that count."""
        return self._live(self._read("postings", wanted)).drop("segment").withColumn("at", _unpacked(F.col("at")))

    def words(self, wanted: list[str] | None = None) -> DataFrame:
        """(term, n, times): chunks with a term and its occurrences; counted from the postings where there are dead chunks."""
        if self.dead_rows:
            return self.postings(wanted).groupBy("term").agg(F.count("*").alias("n"), F.sum(F.size("at")).alias("times"))
        return self._read("terms", wanted).groupBy("term").agg(F.sum("n").alias("n"), F.sum("times").alias("times"))

    def chunks(self, marks: bool = False) -> DataFrame:
        """key, d and the kept columns of the chunks that count (with marks: the digest and segment too)."""
        rows = self._live(self._read("chunks", None))
        return rows if marks else rows.drop("mark", "segment")


def _write_version(spark: SparkSession, home: str, key: str, fields: Mapping[str, float], kept: list[str], segments: list[Segment], dead: DataFrame | None, dead_schema: str) -> str:
    path = stores.new_version(home)
    (spark.createDataFrame([], dead_schema) if dead is None else dead).write.parquet(f"{path}/dead")
    gone = spark.read.schema(dead_schema).parquet(f"{path}/dead").agg(F.count("*").alias("n"), F.coalesce(F.sum("d"), F.lit(0)).alias("d")).first()
    n, tokens = sum(s.chunks for s in segments) - gone["n"], sum(s.tokens for s in segments) - gone["d"]
    row = (SCHEMA_VERSION, key, json.dumps(dict(fields)), n, tokens / n if n else None, gone["n"], json.dumps(kept), json.dumps([asdict(s) for s in segments]))
    spark.createDataFrame([row], "schema_version string, key string, fields string, n long, avgdl double, dead long, kept string, segments string").coalesce(1).write.parquet(f"{path}/meta")
    before = stores.current(spark, home)
    named = {s.name for s in segments} | ({s.name for s in Index(spark, before).segments} if before else set())
    stores.swap(spark, home, path)
    stores.remove_but(spark, home, "segment-", named)
    return path


def _dead_schema(chunks: DataFrame, key: str) -> str:
    return f"segment string, `{key}` {chunks.schema[key].dataType.simpleString()}, d long"


def build(chunks: DataFrame, key: str, fields: Mapping[str, float], home: str, facets: tuple[str, ...] = (), shown: tuple[str, ...] = ()) -> str:
    """Write an index of chunks (distinct keys; null ones are left out) below home and make it current; returns the version's path."""
    kept = [c for c in dict.fromkeys((*facets, *shown)) if c != key]
    rows = chunks.where(F.col(key).isNotNull()).withColumn("mark", _digest(chunks, [*fields, *kept]))
    segment = _write_segment(rows, key, fields, home, kept)
    return _write_version(chunks.sparkSession, home, key, fields, kept, [segment], None, _dead_schema(chunks, key))


def update(chunks: DataFrame, home: str, whole: bool = True) -> str:
    """Bring the current index to the given rows; returns the version's path (the current one where nothing changed).

    Rows are told apart by digests; whole says that keys that are not given are gone, else they stay."""
    spark = chunks.sparkSession
    path = stores.current(spark, home)
    ix = Index(spark, path)
    key = ix.key
    rows = chunks.where(F.col(key).isNotNull()).withColumn("mark", _digest(chunks, [*ix.fields, *ix.kept]))
    held = ix.chunks(marks=True).select(key, "segment", "d", F.col("mark").alias("old"))
    changed = staged(rows.select(key, "mark").join(held, key, "full" if whole else "left").where(~F.col("mark").eqNullSafe(F.col("old"))), "index-changes")
    told = changed.agg(F.count("mark").alias("fresh"), F.count("old").alias("gone")).first()
    if not told["fresh"] and not told["gone"]:
        return path
    segments, dead = list(ix.segments), changed.where("old IS NOT NULL").select("segment", key, "d")
    if told["fresh"]:
        fresh = staged(rows.join(changed.where("mark IS NOT NULL").select(key), key, "left_semi"), "index-fresh")
        segments.append(_write_segment(fresh, key, ix.fields, home, ix.kept))
    return _write_version(spark, home, key, ix.fields, ix.kept, segments, ix.dead().unionByName(dead), _dead_schema(chunks, key))


def to_merge(segments: list[Segment], dead: Mapping[str, int], fan: int = FAN) -> list[list[Segment]]:
    """Groups to write together: at least fan segments whose live chunks are of one power of fan, and mostly dead segments alone."""
    classes: dict[int, list[Segment]] = {}
    for s in segments:
        live = max(1, s.chunks - dead.get(s.name, 0))
        classes.setdefault(int(math.log(live) / math.log(fan) + 1e-9), []).append(s)
    groups = [some for some in classes.values() if len(some) >= fan]
    taken = {s.name for some in groups for s in some}
    return groups + [[s] for s in segments if s.name not in taken and s.chunks and dead.get(s.name, 0) / s.chunks >= ROTTEN]


def merge(spark: SparkSession, home: str, fan: int = FAN, split: int = SPLIT, whole: bool = False) -> str:
    """Merge what to_merge() names (with whole, everything into one segment), without the dead; returns the version's path."""
    path = stores.current(spark, home)
    ix = Index(spark, path)
    key = ix.key
    dead = {r["segment"]: r["n"] for r in ix.dead().groupBy("segment").agg(F.count("*").alias("n")).collect()}  # a row for a segment
    groups = to_merge(ix.segments, dead, fan) if not whole else [ix.segments] if len(ix.segments) > 1 or dead else []
    if not groups:
        return path
    segments, old = list(ix.segments), []
    for some in groups:
        name = f"segment-{uuid.uuid4().hex}"
        ix._live(ix._read("chunks", None, some)).drop("segment").write.parquet(f"{home}/{name}/chunks")
        one = spark.read.parquet(f"{home}/{name}/chunks").agg(F.count("*").alias("n"), F.coalesce(F.sum("d"), F.lit(0)).alias("tokens")).first()
        fresh = Segment(name, shards_for(one["tokens"]), one["n"], one["tokens"])
        rows = ix._live(ix._read("postings", None, some)).drop("segment")
        parts: dict[str, int] = {}
        if fresh.chunks > split:
            counted = ix._read("terms", None, some).groupBy("term").agg(F.sum("n").alias("n")).where(F.col("n") > split)
            parts = _parts(counted.select("term", F.ceil(F.col("n") / split).cast("int").alias("parts")))
        part = F.lit(0)
        if parts:
            rows = rows.join(F.broadcast(spark.createDataFrame(list(parts.items()), "term string, parts int")), "term", "left")
            part = F.coalesce(F.pmod(F.xxhash64(key), "parts"), F.lit(0)).cast("int")
        blocks = rows.select("term", part.alias("part"), F.array(key).alias("keys"), F.array("at").alias("at"))
        _write_postings(blocks, key, f"{home}/{name}", fresh.shards, parts)
        old += [s.name for s in some]
        segments = [s for s in segments if s not in some] + ([fresh] if fresh.chunks else [])
    left = ix.dead().where(~F.col("segment").isin(old))
    return _write_version(spark, home, key, ix.fields, ix.kept, segments or [fresh], left, _dead_schema(ix.dead(), key))
