"""Compact codes of vectors: product quantisation by Lloyd rounds in whole numbers, with Hamerly's bounds.

Every component becomes floor(scale * x), vectors are cut into equal consecutive parts, and each part position has a
codebook of its own. A round assigns every part to its nearest entry (squared Euclidean distance, ties to the
lower index) and replaces entries by the floored means of their parts.

Vectors travel as rows of blocks: an Arrow batch of them (at most BATCH_ROWS) with, for each vector and part, the entry, an upper
bound on the distance to it and a lower bound on the distance to the second-nearest. Both are persisted from round to
round in a staged table, the last one going when the next is written, so a lost executor costs a block's round. When
entries move, upper bounds grow by their entry's move and lower ones shrink by the farthest move of another. Only where upper <
lower (or < half the distance from the entry to its nearest neighbour) fails strictly is the part's own distance computed, and
only where it fails again are all entries scanned, in whole numbers; as the test is strict, a tie is always
scanned and goes to the lower index. Bounds are 32-bit floats rounded away from the claim.

A block carries the sums and counts of its parts by entry, which are added up over the cluster; the driver sees one row of
totals a number of the codebooks (entries x dimensions), never vectors.

Defined results for odd input: null vectors, those that hold null or non-finite components, empty ones, and those of another length
than that of the smallest kept vec_id are dropped; a length that the number of parts does not divide is cut as evenly
as can be; components beyond +-2^24 after scaling count as +-2^24; fewer vectors than entries make shorter codebooks; repeated
vec_ids are rows of their own, in the order of their components where the start of the codebooks depends on it; a null vec_id
sorts last; other columns are passed over; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.session import drop_staged, scratch, ship, table

SCALE, PARTS, ENTRIES, ROUNDS = 4096, 8, 16, 6
#: Components after scaling lie within this: sums of squares of thousands of them fit 64 bits.
LIMIT = 2**24
#: Above the relative error of a double square root.
SLACK = 1e-12

BLOCK = "vec_id array<long>, label array<string>, x binary, near binary, upper binary, lower binary, sums array<long>, scans long"


def cuts(dim: int, parts: int) -> list[int]:
    return [dim * p // parts for p in range(parts + 1)]


def _above(v: np.ndarray) -> np.ndarray:
    """32-bit floats that are at least v (a distance)."""
    return np.nextafter((v * (1 + SLACK)).astype(np.float32), np.float32(np.inf))


def _below(v: np.ndarray) -> np.ndarray:
    return np.nextafter((v * (1 - SLACK)).astype(np.float32), np.float32(-np.inf))


def squares(x: np.ndarray, book: np.ndarray) -> np.ndarray:
    """Squared distances of all rows to all entries, in whole numbers."""
    return np.stack([((x - entry) ** 2).sum(1) for entry in book], 1)


@dataclass
class Bounds:
    """Of one part position: the entry of each row, an upper bound on its distance and a lower one on the second-nearest's."""

    near: np.ndarray
    upper: np.ndarray
    lower: np.ndarray


def scan(x: np.ndarray, book: np.ndarray) -> Bounds:
    far = squares(x, book)
    near, rows = far.argmin(1), np.arange(len(x))
    first = far[rows, near]
    second = np.full(len(x), np.inf)
    if len(book) > 1:
        far[rows, near] = np.iinfo(np.int64).max
        second = np.sqrt(far.min(1).astype(np.float64))
    return Bounds(near.astype(np.uint8), _above(np.sqrt(first.astype(np.float64))), _below(second))


def reassign(x: np.ndarray, was: np.ndarray, book: np.ndarray, held: Bounds) -> tuple[Bounds, int]:
    """The assignment to book of rows that were bounded under the codebook was, and how many rows were scanned in full."""
    moved = np.sqrt(((book - was) ** 2).sum(1).astype(np.float64))
    near, upper, lower = held.near.copy(), held.upper.astype(np.float64), held.lower.astype(np.float64)
    farthest = np.array([np.delete(moved, k).max(initial=0.0) for k in range(len(book))])
    upper, lower = _above(upper + moved[near]), _below(lower - farthest[near])
    apart = squares(book, book).astype(np.float64)
    np.fill_diagonal(apart, np.inf)
    least = np.maximum(lower, _below(np.sqrt(apart.min(1)) / 2)[near])
    loose = np.flatnonzero(~(upper < least))
    upper[loose] = _above(np.sqrt(((x[loose] - book[near[loose]]) ** 2).sum(1).astype(np.float64)))
    loose = loose[~(upper[loose] < least[loose])]
    if len(loose):
        found = scan(x[loose], book)
        near[loose], upper[loose], lower[loose] = found.near, found.upper, found.lower
    return Bounds(near, upper, lower), len(loose)


def sums_of(x: np.ndarray, near: np.ndarray, entries: int) -> np.ndarray:
    """For each entry the componentwise sums of its rows, then their number."""
    out = np.zeros((entries, x.shape[1] + 1), np.int64)
    order = np.argsort(near, kind="stable")
    used, first = np.unique(near[order], return_index=True)
    if len(used):
        out[used, :-1] = np.add.reduceat(x[order], first, axis=0)
        out[used, -1] = np.diff(np.append(first, len(order)))
    return out


def means(book: np.ndarray, sums: np.ndarray) -> np.ndarray:
    """The next codebook: floored means; an unused entry stays. sums may hold Python integers."""
    return np.array([[int(s) // int(row[-1]) for s in row[:-1]] if row[-1] else list(old) for old, row in zip(book, sums, strict=True)], np.int64).reshape(book.shape)


def digest(books: list[np.ndarray]) -> str:
    """SHA-256 of all components in order of part, entry and place, comma-joined."""
    return hashlib.sha256(",".join(str(c) for book in books for c in book.reshape(-1).tolist()).encode()).hexdigest()


def sound(vector: Column) -> Column:
    """True for a vector with components, all of them finite numbers."""
    whole = F.forall(vector, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    return F.coalesce(vector.isNotNull() & (F.size(vector) > 0) & whole, F.lit(False))


def scaled(values: np.ndarray, scale: int) -> np.ndarray:
    return np.clip(np.floor(values * scale), -LIMIT, LIMIT).astype(np.int32)


def _packed(vec_id: pa.Array, label: pa.Array, x: np.ndarray, parts: list[Bounds], sums: list[np.ndarray], scans: int) -> pa.RecordBatch:
    blobs = [pa.array([v.tobytes()], pa.binary()) for v in (x, *(np.stack([getattr(p, name) for p in parts], 1) for name in ("near", "upper", "lower")))]
    lists = [pa.ListArray.from_arrays(pa.array([0, len(v)], pa.int32()), v) for v in (vec_id, label)]
    flat = pa.array([np.concatenate([s.reshape(-1) for s in sums]).tolist()], pa.list_(pa.int64()))
    return pa.RecordBatch.from_arrays([*lists, *blobs, flat, pa.array([scans], pa.int64())], names=["vec_id", "label", "x", "near", "upper", "lower", "sums", "scans"])


def _blocks(batches: Iterator[pa.RecordBatch], dim: int, parts: int) -> Iterator[tuple[pa.RecordBatch, int, np.ndarray, list[Bounds]]]:
    """Each block of a persisted table: its one-row batch with the row's number, components, and bounds by part."""
    for batch in batches:
        for k in range(batch.num_rows):
            blob = lambda name, kind, width: np.frombuffer(batch.column(name)[k].as_buffer(), kind).reshape(-1, width)  # noqa: B023, E731
            near, upper, lower = blob("near", np.uint8, parts), blob("upper", np.float32, parts), blob("lower", np.float32, parts)
            yield batch, k, blob("x", np.int32, dim).astype(np.int64), [Bounds(near[:, p], upper[:, p], lower[:, p]) for p in range(parts)]


def _totals(blocks: DataFrame, books: list[np.ndarray]) -> list[np.ndarray]:
    """The sums of all blocks: one row for each number of the codebooks and its counts comes to the driver."""
    each = blocks.select(F.posexplode("sums").alias("at", "s")).groupBy("at").agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s"))
    flat = np.zeros(sum(len(b) * (b.shape[1] + 1) for b in books), object)
    for r in each.collect():
        flat[r["at"]] = int(r["s"])
    ends = np.cumsum([len(b) * (b.shape[1] + 1) for b in books])[:-1]
    return [s.reshape(len(b), -1) for s, b in zip(np.split(flat, ends), books, strict=True)]


def train(rows: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> tuple[DataFrame, list[np.ndarray], list[int]]:
    """rows(vec_id, label string, embedding array<double>, sound) -> vec_id, label, code, error; the codebooks; full scans by round."""
    spark = rows.sparkSession
    ship(spark)
    if entries > 256:
        raise ValueError("an entry is written in two hex digits")
    first = rows.orderBy(F.col("vec_id").asc_nulls_last(), "embedding").select("embedding").limit(entries).collect()
    start = [r["embedding"] for r in first if len(r["embedding"]) == len(first[0]["embedding"])]
    if not start:
        return spark.createDataFrame([], "vec_id long, label string, code string, error long"), [], []
    dim = len(start[0])
    if len(start) < len(first):  # other lengths are dropped, so look past them
        start = [r["embedding"] for r in rows.where(F.size("embedding") == dim).orderBy(F.col("vec_id").asc_nulls_last(), "embedding").select("embedding").limit(entries).collect()]
    at = cuts(dim, parts)
    whole = scaled(np.array(start, np.float64), scale).astype(np.int64)
    books = [whole[:, a:b] for a, b in zip(at, at[1:], strict=False)]
    pieces = [slice(a, b) for a, b in zip(at, at[1:], strict=False)]

    def begin(batches: Iterator[pa.RecordBatch], books=books) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x = scaled(batch.column("embedding").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, dim), scale)
                wide = x.astype(np.int64)
                found = [scan(wide[:, s], book) for s, book in zip(pieces, books, strict=True)]
                sums = [sums_of(wide[:, s], f.near, len(b)) for s, f, b in zip(pieces, found, books, strict=True)]
                yield _packed(batch.column("vec_id"), batch.column("label"), x, found, sums, batch.num_rows * parts)

    def persisted(df: DataFrame) -> tuple[str, DataFrame]:
        path = scratch(spark, "codes")
        df.write.parquet(path)
        return path, spark.read.schema(df.schema).parquet(path)

    path, blocks = persisted(rows.where(F.size("embedding") == dim).select("vec_id", "label", "embedding").mapInArrow(begin, BLOCK))
    scans = [blocks.agg(F.sum("scans")).first()[0]]
    for _ in range(rounds - 1):
        was, books = books, [means(b, s) for b, s in zip(books, _totals(blocks, books), strict=True)]

        def again(batches: Iterator[pa.RecordBatch], was=was, books=books) -> Iterator[pa.RecordBatch]:
            for batch, k, x, held in _blocks(batches, dim, parts):
                found = [reassign(x[:, s], w, b, h) for s, w, b, h in zip(pieces, was, books, held, strict=True)]
                sums = [sums_of(x[:, s], f.near, len(b)) for s, (f, _), b in zip(pieces, found, books, strict=True)]
                yield _packed(batch.column("vec_id")[k].values, batch.column("label")[k].values, x.astype(np.int32), [f for f, _ in found], sums, sum(n for _, n in found))

        old = path
        path, blocks = persisted(blocks.mapInArrow(again, BLOCK))
        drop_staged(spark, old)
        scans.append(blocks.agg(F.sum("scans")).first()[0])
    was, books = books, [means(b, s) for b, s in zip(books, _totals(blocks, books), strict=True)]

    def finish(batches: Iterator[pa.RecordBatch], was=was, books=books) -> Iterator[pa.RecordBatch]:
        for batch, k, x, held in _blocks(batches, dim, parts):
            near = np.stack([reassign(x[:, s], w, b, h)[0].near for s, w, b, h in zip(pieces, was, books, held, strict=True)], 1)
            error = sum(((x[:, s] - b[near[:, p]]) ** 2).sum(1) for p, (s, b) in enumerate(zip(pieces, books, strict=True)))
            text = np.ascontiguousarray(near).tobytes().hex()
            codes = [text[i : i + 2 * parts] for i in range(0, len(text), 2 * parts)]
            yield pa.RecordBatch.from_arrays([batch.column("vec_id")[k].values, batch.column("label")[k].values, pa.array(codes), pa.array(error)], names=["vec_id", "label", "code", "error"])

    path, coded = persisted(blocks.mapInArrow(finish, "vec_id long, label string, code string, error long"))
    return coded, books, scans


def encode(embeddings: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> DataFrame:
    """embeddings(vec_id, embedding, label) -> vec_id, code, error, label_error, codebooks_sha256."""
    array = F.col("embedding").cast("array<double>")
    rows = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("string").alias("label"), array.alias("embedding")).where(sound(array))
    coded, books, _ = train(rows, parts, entries, rounds, scale)
    by_label = coded.groupBy(F.col("label").alias("of")).agg(F.sum("error").alias("label_error"))
    joined = coded.join(by_label, F.col("label").eqNullSafe(F.col("of")))
    return joined.select("vec_id", "code", "error", "label_error", F.lit(digest(books)).alias("codebooks_sha256"))


def op11_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode(table(spark, sf_dir, "embeddings"))


def _sql(parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> str:
    """The same rounds as a chain of tables: b0 .. b6 are codebooks, a1 .. a7 assignments."""
    steps = []
    for r in range(1, rounds + 2):
        steps.append(f"""d{r} AS MATERIALIZED (SELECT c.vec_id, c.part, b.entry, sum((c.x - b.y) * (c.x - b.y)) AS d FROM cell c JOIN b{r - 1} b ON b.part = c.part AND b.place = c.place GROUP BY ALL),
a{r} AS MATERIALIZED (SELECT vec_id, part, arg_min(entry, (d, entry)) AS entry, min(d) AS d FROM d{r} GROUP BY ALL)""")
        if r <= rounds:
            steps.append(f"""s{r} AS (SELECT a.part, a.entry, c.place, sum(c.x) AS s, count(*) AS n FROM a{r} a JOIN cell c ON c.vec_id = a.vec_id AND c.part = a.part GROUP BY ALL),
b{r} AS MATERIALIZED (SELECT b.part, b.entry, b.place, CASE WHEN s.n IS NULL THEN b.y ELSE (s.s - (s.s % s.n + s.n) % s.n) // s.n END::HUGEINT AS y FROM b{r - 1} b LEFT JOIN s{r} s USING (part, entry, place))""")
    return f"""
WITH v AS (SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
cell AS MATERIALIZED (SELECT vec_id, (k - 1) // (len(e) // {parts}) AS part, (k - 1) % (len(e) // {parts}) AS place, floor({scale} * e[k])::HUGEINT AS x FROM (SELECT vec_id, e, unnest(range(1, len(e) + 1)) AS k FROM v)),
b0 AS MATERIALIZED (SELECT c.part, f.entry, c.place, c.x AS y FROM (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS entry FROM v ORDER BY vec_id LIMIT {entries}) f JOIN cell c USING (vec_id)),
{",".join(steps)},
coded AS (SELECT vec_id, string_agg(printf('%02x', entry), '' ORDER BY part) AS code, sum(d)::BIGINT AS error FROM a{rounds + 1} GROUP BY vec_id),
book AS (SELECT sha256(string_agg(y::VARCHAR, ',' ORDER BY part, entry, place)) AS codebooks_sha256 FROM b{rounds})
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256 FROM coded JOIN v USING (vec_id), book
"""


OP11_SQL = _sql()
