"""Exact top-k search by inner product: distributed histogram selection.

Components become floor(scale * x). Equal vectors are one group, which stands with at most k + 1 of its smallest ids (no other can
be among any query's k best), so that a group of copies of any size is one column of the scores. Queries with equal vectors are
one row. A query's k best of all rows but its own are the k + 1 best of all rows without its own.

Scores are made in tiles: a block of candidates is held by a task, and a group of queries streams past it. Tiles are what is
shuffled, never scores; each pass makes the scores anew (a matrix product of whole numbers, in floats only
where these are exact). The first pass counts each query's scores in at most BINS bins of the whole range, sending of a tile
only the bins from its own k-th best score up: lower ones cannot hold the k-th best of all. Counts are added
up, the bin of the k-th best is found by a running sum, and the next pass counts the scores inside it, until a bin is one score. The last pass
returns the rows above that score and, of those at it, the smallest ids that are needed from each tile.

Defined results for odd input: vectors that are null, empty, or hold null or non-finite components, and rows with a null
vec_id, take no part; vectors are compared with those of their own length; components beyond +-2^26 after scaling count as +-2^26;
repeated ids are rows of their own, and a query leaves out one row, itself; fewer than k other rows give fewer; other columns are passed
over; an empty table, or one without queries, gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quarry.llm.codes import sound
from quarry.session import ship, staged, table

K, SCALE, EVERY = 20, 64, 20
LIMIT = 2**26
#: log2 of the bins that a pass counts in.
BIN_BITS = 8
#: Candidates of a tile: at least the first, and more where there would be over TILES blocks, up to the second or TILE_BYTES of doubles.
TILE_ROWS, MOST_TILE_ROWS, TILES, TILE_BYTES = 8192, 65536, 512, 128_000_000
#: Queries of a tile (they stream), and those whose scores are held at once: as many as make SCORES of them.
TILE_QUERIES, SCORES = 65536, 2_000_000


def tiling(candidates: int, queries: int, dim: int) -> tuple[int, int]:
    """Numbers of candidate blocks and of query groups."""
    most = max(1, min(MOST_TILE_ROWS, TILE_BYTES // (8 * max(1, dim))))
    rows = min(most, max(TILE_ROWS, -(-candidates // TILES)))
    return max(1, -(-candidates // rows)), max(1, -(-queries // TILE_QUERIES))


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of whole rows, exact: floats are used only where no sum of products can pass their whole numbers."""
    most = int(np.abs(a).max(initial=0)) * int(np.abs(b).max(initial=0)) * a.shape[1]
    if most < 2**24:
        return (a.astype(np.float32) @ b.astype(np.float32).T).astype(np.int64)
    if most < 2**53:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    return a.astype(np.int64) @ b.astype(np.int64).T


@dataclass
class Pass:
    """What a pass looks for: counts of bins (shift, and above it the shift of the last pass or None), or the rows themselves (shift None)."""

    lowest: int
    keep: int
    shift: int | None
    held: int | None


def tile_counts(scores: np.ndarray, n: np.ndarray, prefix: np.ndarray, now: Pass) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, bin, count) of the scores of a tile that a pass counts; n is how many rows stand in a column."""
    t = scores - now.lowest
    if now.held is not None:
        use = (t >> now.held) == prefix[:, None]
    elif t.shape[1] > now.keep:  # the tile's own keep-th best bounds that of all from below
        use = t >> now.shift >= (np.partition(t, -now.keep, axis=1)[:, [-now.keep]] >> now.shift)
    else:
        use = np.ones(t.shape, bool)
    row, column = np.nonzero(use)
    bins = t[row, column] >> now.shift
    by = np.lexsort((bins, row))
    row, bins, many = row[by], bins[by], n[column][by]
    first = np.flatnonzero(np.append(True, (np.diff(row) != 0) | (np.diff(bins) != 0)))[: len(row)]
    return row[first], bins[first], np.add.reduceat(many, first) if len(first) else many


def tile_rows(scores: np.ndarray, offsets: np.ndarray, ids: np.ndarray, kth: np.ndarray, need: np.ndarray, now: Pass) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, column, id) of the scores above kth, and of those at it the smallest need ids of the tile."""
    t = scores - now.lowest
    row, column = np.nonzero(t >= kth[:, None])
    n = offsets[column + 1] - offsets[column]
    at = np.repeat(offsets[column] - (np.cumsum(n) - n), n) + np.arange(n.sum())
    row, column, found = np.repeat(row, n), np.repeat(column, n), ids[at]
    tied = t[row, column] == kth[row]
    by = np.lexsort((found, ~tied, row))  # a row's ties come first, by id
    row, column, found, tied = row[by], column[by], found[by], tied[by]
    place = np.arange(len(row)) - np.searchsorted(row, row)
    use = ~tied | (place < need[row])
    return row[use], column[use], found[use]


def _by_length(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The vectors of a list column by their length: places and matrix."""
    sizes = column.value_lengths().to_numpy()
    for dim in np.unique(sizes):
        at = np.flatnonzero(sizes == dim)
        yield at, column.take(pa.array(at)).flatten().to_numpy().reshape(len(at), dim)


def _tiled(tiles: DataFrame, now: Pass, parts: int, schema: str) -> DataFrame:
    """One pass over tiles(tile, kind, g, v, ids, prefix, need): rows of a tile are sorted, candidates (kind 0) first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tile, waiting = None, []
        held: dict[int, tuple[np.ndarray, ...]] = {}

        def gather() -> None:
            rows = pa.Table.from_batches(waiting).combine_chunks()
            lists = rows.column("ids").combine_chunks()
            sizes = lists.value_lengths().to_numpy()
            for at, x in _by_length(rows.column("v").combine_chunks()):
                ids = lists.take(pa.array(at)).flatten().to_numpy()
                held[x.shape[1]] = (rows.column("g").to_numpy()[at], x, np.concatenate(([0], np.cumsum(sizes[at]))), ids)
            waiting.clear()

        for batch in batches:
            names, kinds = batch.column("tile").to_numpy(), batch.column("kind").to_numpy()
            edges = np.flatnonzero(np.append(True, (np.diff(names) != 0) | (np.diff(kinds) != 0)))[: len(names)]
            for a, b in zip(edges, [*edges[1:], len(names)], strict=True):
                some = batch.slice(a, b - a)
                if names[a] != tile:
                    tile, waiting = names[a], []
                    held.clear()
                if kinds[a] == 0:
                    waiting.append(some)
                    continue
                if waiting:
                    gather()
                g, prefix, need = (some.column(c).to_numpy() for c in ("g", "prefix", "need"))
                for at, q in _by_length(some.column("v")):
                    if q.shape[1] not in held:
                        continue
                    other, x, offsets, ids = held[q.shape[1]]
                    step = max(1, SCORES // len(x))
                    for s in range(0, len(q), step):
                        mine = at[s : s + step]
                        scores = products(q[s : s + step], x)
                        if now.shift is not None:
                            row, bins, n = tile_counts(scores, np.diff(offsets), prefix[mine], now)
                            yield pa.RecordBatch.from_arrays([pa.array(g[mine[row]]), pa.array(bins), pa.array(n)], names=["g", "bin", "n"])
                        else:
                            row, column, found = tile_rows(scores, offsets, ids, prefix[mine], need[mine], now)
                            yield pa.RecordBatch.from_arrays([pa.array(g[mine[row]]), pa.array(scores[row, column]), pa.array(found), pa.array(other[column])], names=["g", "score", "vec_id", "other"])

    return tiles.repartition(parts, "tile").sortWithinPartitions("tile", "kind").mapInArrow(run, schema)


def _narrowed(counts: DataFrame, state: DataFrame) -> DataFrame:
    """counts(g, bin, n), state(g, need) -> g, prefix (the bin of the need-th best, the lowest one if there are fewer), need (what is left to find in it)."""
    whole = counts.groupBy("g", "bin").agg(F.sum("n").alias("n"))
    running = whole.withColumn("running", F.sum("n").over(Window.partitionBy("g").orderBy(F.desc("bin")))).join(state.select("g", "need"), "g")
    hit, above = F.col("running") >= F.col("need"), F.col("running") - F.col("n")
    return running.groupBy("g").agg(
        F.coalesce(F.max(F.when(hit, F.col("bin"))), F.min("bin")).alias("prefix"),
        (F.first("need") - F.coalesce(F.min(F.when(hit, above)), F.max(above))).alias("need"),
    )


def search(vectors: DataFrame, k: int = K, every: int = EVERY, scale: int = SCALE) -> DataFrame:
    """vectors(vec_id, embedding); queries are the rows whose id every divides -> query_id, rank, vec_id, score."""
    spark = vectors.sparkSession
    ship(spark)
    array = F.col("embedding").cast("array<double>")
    whole = F.transform(array, lambda x: F.greatest(F.lit(-LIMIT), F.least(F.lit(LIMIT), F.floor(x * scale))).cast("int"))
    rows = staged(vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.when(sound(array), whole).alias("v")).where("vec_id IS NOT NULL AND v IS NOT NULL"), "topk-rows")
    keep = k + 1
    # Ranks that are filtered are cut before the shuffle too, so that a group of copies sends keep rows from a task.
    first = rows.withColumn("place", F.row_number().over(Window.partitionBy("v").orderBy("vec_id"))).where(F.col("place") <= keep)
    groups = staged(first.groupBy("v").agg(F.sort_array(F.collect_list("vec_id")).alias("ids")).withColumn("g", F.monotonically_increasing_id()), "topk-groups")
    asked = staged(rows.where(F.pmod("vec_id", F.lit(every)) == 0).join(groups.select("v", "g"), "v").select("vec_id", "g"), "topk-queries")
    queries = groups.join(asked.select("g").distinct(), "g", "left_semi").select("g", "v")
    size = F.aggregate("v", F.lit(0.0), lambda n, x: n + x.cast("double") * x)
    stats = groups.agg(F.count("*").alias("n"), F.max(F.size("v")).alias("dim"), F.max(size).alias("most")).first()
    schema = "query_id long, rank int, vec_id long, score long"
    if not stats["n"]:
        return spark.createDataFrame([], schema)
    # |score| is at most the largest squared length.
    most = int(stats["most"] * (1 + 1e-9)) + 1
    across, down = tiling(stats["n"], asked.select("g").distinct().count(), stats["dim"])
    parts = min(across * down, 20_000)
    each = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    candidates = groups.select("g", "v", "ids", F.pmod(F.xxhash64("g"), F.lit(across)).alias("block"), each(down).alias("team"))
    candidates = candidates.select((F.col("team") * across + F.col("block")).cast("long").alias("tile"), F.lit(0).alias("kind"), "g", "v", "ids", F.lit(0).cast("long").alias("prefix"), F.lit(0).cast("long").alias("need"))

    def tiles(state: DataFrame) -> DataFrame:
        sent = state.select("g", "v", "prefix", "need", F.pmod(F.xxhash64("g"), F.lit(down)).alias("team"), each(across).alias("block"))
        return candidates.unionByName(sent.select((F.col("team") * across + F.col("block")).cast("long").alias("tile"), F.lit(1).alias("kind"), "g", "v", F.array().cast("array<bigint>").alias("ids"), "prefix", "need"))

    state = queries.withColumns({"prefix": F.lit(0).cast("long"), "need": F.lit(keep).cast("long")})
    bits = (2 * most).bit_length()
    shift: int | None = None
    while shift != 0:
        before, shift = shift, max(0, (bits if shift is None else shift) - BIN_BITS)
        chosen = _narrowed(_tiled(tiles(state), Pass(-most, keep, shift, before), parts, "g long, bin long, n long"), state)
        state = staged(queries.join(chosen, "g"), "topk-state")
    found = _tiled(tiles(state), Pass(-most, keep, None, None), parts, "g long, score long, vec_id long, other long")
    best = found.withColumn("place", F.row_number().over(Window.partitionBy("g").orderBy(F.desc("score"), "vec_id"))).where(F.col("place") <= keep)
    lists = staged(best.groupBy("g").agg(F.array_sort(F.collect_list(F.struct("place", "vec_id", "score", "other"))).alias("best")), "topk-lists")
    joined = asked.withColumnRenamed("vec_id", "query_id").join(lists, "g")
    own = F.array_position(F.transform("best", lambda x: (x["vec_id"] == F.col("query_id")) & (x["other"] == F.col("g"))), F.lit(True))
    others = joined.select("query_id", "best", own.alias("own")).select("query_id", F.slice(F.filter("best", lambda x: x["place"] != F.col("own")), 1, k).alias("best"))
    return others.select("query_id", F.posexplode("best").alias("at", "x")).select("query_id", (F.col("at") + 1).alias("rank"), "x.vec_id", "x.score")


def op12_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(table(spark, sf_dir, "embeddings"))


OP12_SQL = """
WITH v AS (SELECT vec_id, list_transform(embedding::DOUBLE[], lambda x: floor(64 * x)) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, v.vec_id, list_inner_product(q.e, v.e)::BIGINT AS score FROM v q JOIN v ON q.vec_id <> v.vec_id WHERE q.vec_id % 20 = 0),
r AS (SELECT query_id, (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id))::INTEGER AS rank, vec_id, score FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20
"""
