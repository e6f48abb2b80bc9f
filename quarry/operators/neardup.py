"""Near-duplicate text: shingles, exact similarity, MinHash signatures, banding and clusters."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.graph import connected_components
from quarry.session import ship, spread, staged

#: The modulus and the mask of the permutation family.
PRIME, MASK = 2**61 - 1, 2**32 - 1


def shingles(text: Column, k: int = 3) -> Column:
    """Distinct k-word shingles of the lower-cased text; a shorter text is one shingle, an empty one none."""
    w = F.regexp_extract_all(F.lower(text), F.lit(r"([\p{L}\p{N}_]+)"), F.lit(1))

    def spans(w: Column) -> Column:
        each = F.transform(F.sequence(F.lit(1), F.greatest(F.size(w) - k + 1, F.lit(1))), lambda i: F.array_join(F.slice(w, i, k), " "))
        return F.when(F.size(w) == 0, F.array().cast("array<string>")).otherwise(F.array_distinct(each))

    # Bound as a variable: inside another lambda the words would be extracted again for each shingle.
    return F.transform(F.array(w), spans)[0]


def jaccard(a: Column, b: Column) -> Column:
    """Share of common members; 0 where both are empty."""
    union = F.size(F.array_union(a, b))
    return F.when(union == 0, 0.0).otherwise(F.size(F.array_intersect(a, b)) / union)


def coefficients(i: int) -> tuple[int, int]:
    """Multiplier and offset of permutation i, from the digest of its decimal number."""
    digest = hashlib.sha256(str(i).encode()).digest()
    return 1 + int.from_bytes(digest[:8], "big") % (PRIME - 1), int.from_bytes(digest[8:16], "big") % PRIME


def shingle_hash(s: Column) -> Column:
    """The first 8 bytes of the SHA-1 as an unsigned number, a decimal."""
    return F.conv(F.substring(F.sha1(s), 1, 16), 16, 10).cast("decimal(20,0)")


def minhash_exact(hashes: Column, i: int) -> Column:
    """Permutation i's minimum with decimal arithmetic: for checks; minhash() is the fast path."""
    a, b = coefficients(i)
    lit = lambda n: F.lit(str(n)).cast("decimal(38,0)")
    each = F.transform(hashes, lambda h: ((h.cast("decimal(38,0)") * F.lit(str(a)).cast("decimal(19,0)") + lit(b)) % lit(PRIME)).cast("decimal(38,0)") % lit(MASK + 1))
    return F.coalesce(F.array_min(each).cast("long"), F.lit(MASK))


def shingle_set(text: Column, k: int = 3) -> Column:
    """The text's distinct shingles as 64-bit hashes, for comparing sets of one corpus."""
    return F.array_distinct(F.transform(shingles(text, k), lambda s: F.xxhash64(s)))


def signed_hash(s: Column) -> Column:
    """shingle_hash() as the signed long of the same bits, which travels in eight bytes."""
    return F.conv(F.substring(F.sha1(s), 1, 16), 16, -10).cast("long")


def _permuted(h: np.ndarray, family: np.ndarray) -> np.ndarray:
    """(a*h + b) mod 2**61-1 of all hashes (columns) under all permutations (rows), in unsigned arithmetic by parts of 31 bits.

    2**61 is 1 and 2**62 is 2, so that products are folded by shifts and never divided."""
    p, low30, low31 = np.uint64(PRIME), np.uint64(2**30 - 1), np.uint64(2**31 - 1)
    h = (h & p) + (h >> np.uint64(61))
    h = np.where(h >= p, h - p, h)
    a, b = family[:, :1], family[:, 1:]
    h1, h0, a1, a0 = h >> np.uint64(31), h & low31, a >> np.uint64(31), a & low31
    mid = a1 * h0 + a0 * h1  # below 2**62
    x = ((a1 * h1) << np.uint64(1)) + (mid >> np.uint64(30)) + ((mid & low30) << np.uint64(31)) + a0 * h0
    x = (x & p) + (x >> np.uint64(61)) + b
    x = (x & p) + (x >> np.uint64(61))
    return np.where(x >= p, x - p, x)


#: Hashes whose values under 128 permutations a core's cache holds, with those of the steps between.
BLOCK = 256


def signatures(hashes: np.ndarray, sizes: np.ndarray, family: np.ndarray, block: int = BLOCK) -> np.ndarray:
    """Rows of minima for sets that follow each other in one array; an empty set has the mask everywhere."""
    out = np.full((len(sizes), len(family)), MASK, np.int64)
    owner = np.repeat(np.arange(len(sizes)), sizes)
    for s in range(0, len(hashes), block):
        some = owner[s : s + block]
        edge = np.flatnonzero(np.diff(some, prepend=-1))
        least = np.minimum.reduceat(_permuted(hashes[s : s + block], family) & np.uint64(MASK), edge, axis=1)
        out[some[edge]] = np.minimum(out[some[edge]], least.T.astype(np.int64))
    return out


def minhash_of(rows: DataFrame, permutations: int = 128) -> DataFrame:
    """rows with signature in the place of hashes, arrays of signed_hash(): the exact family of coefficients(), in numpy over Arrow batches."""
    ship(rows.sparkSession)
    family = np.array([coefficients(i) for i in range(permutations)], np.uint64)
    kept = [c for c in rows.columns if c != "hashes"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column("hashes")
            sizes = column.value_lengths().to_numpy()
            found = signatures(column.flatten().to_numpy().view(np.uint64), sizes, family)
            flat = pa.array(found.reshape(-1))
            listed = pa.ListArray.from_arrays(pa.array(np.arange(len(sizes) + 1, dtype=np.int32) * permutations), flat)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), listed], names=[*kept, "signature"])

    schema = ", ".join(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in kept)
    return rows.mapInArrow(run, f"{schema}, signature array<long>")


def minhash(docs: DataFrame, key: str = "doc_id", text: str = "text", permutations: int = 128, k: int = 3) -> DataFrame:
    """(key, signature) of texts. Shingles are hashed on the JVM."""
    return minhash_of(spread(docs.select(key, text)).select(key, F.transform(shingles(F.coalesce(F.col(text), F.lit("")), k), signed_hash).alias("hashes")), permutations)


def estimate(a: Column, b: Column) -> Column:
    """Share of equal places of two signatures of one length."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: (x == y).cast("int")), F.lit(0), lambda n, x: n + x) / F.size(a)


def auto_bands(permutations: int, threshold: float) -> int:
    """The fewest bands that divide the length and whose S-curve rises at the threshold or before."""
    divisors = np.flatnonzero(permutations % np.arange(1, permutations + 1) == 0) + 1
    rises = (1.0 / divisors) ** (divisors / permutations)
    return int(divisors[rises <= threshold].min(initial=permutations))


#: Members of a bucket that one task compares at once, and rounds in which members of larger ones are tied to pivots.
BUCKET, PIVOTS = 4096, 6
#: Places of signatures in bands up to which all bands are worked through at once, and members of a batch up to which they are sent to the signatures.
AT_ONCE, SENT = 1_000_000, 200_000


def forest_of(k: np.ndarray, s: np.ndarray, side: np.ndarray, threshold: float, within: bool) -> tuple[np.ndarray, np.ndarray]:
    """Ties of keys whose signatures reach the threshold: among all of them, or only of one side with the other. Those that are joined already,
    as rows of one key or members of a pivot's class are, are not compared again."""
    _, first, place = np.unique(k, return_index=True, return_inverse=True)
    start = first[place]
    if not within:
        for name in np.unique(side):
            if not str(name).startswith("0."):
                some = np.unique(start[side == name])
                start[np.isin(start, some)] = some[0]
    root = start.copy()
    for a in range(len(k) - 1):
        use = root[a + 1 :] != root[a]
        if not within:
            use &= side[a + 1 :] != side[a]
        if not use.any():
            continue
        b = a + 1 + np.flatnonzero(use)
        near = b[(s[b] == s[a]).mean(1) >= threshold]
        for r in {*root[near].tolist()} - {root[a]}:
            root[root == max(r, root[a])] = min(r, root[a])
    tied = np.flatnonzero((root != start) & (start == np.arange(len(k))))
    return k[root[tied]], k[tied]


def _pivoted(members: DataFrame, one: DataFrame, threshold: float, bucket: int) -> tuple[DataFrame, DataFrame | None]:
    """members(band, h, k) of hot buckets -> (band, h, k, c) and edges to pivots.

    In each round a bucket's pivot is a member that has no class yet, by a hash; all members at the threshold from it are its class c and need
    no comparison with each other. c is 0 for those that no round tied."""
    rest, classed, edges = members, None, None
    sign = one.select("k", "s")
    for c in range(1, PIVOTS + 1):
        pivot = rest.groupBy("band", "h").agg(F.min_by("k", F.xxhash64("k", F.lit(c))).alias("p"), F.count("*").alias("n")).where(F.col("n") > bucket)
        pivot = staged(pivot.join(sign.select(F.col("k").alias("p"), F.col("s").alias("ps")), "p").select("band", "h", "p", "ps"), "bucket-pivots")
        if pivot.isEmpty():
            break
        met = rest.join(sign, "k").join(pivot, ["band", "h"], "left").select("band", "h", "k", "p", (estimate(F.col("s"), F.col("ps")) >= threshold).alias("near"))
        met = staged(met, "bucket-classes")
        mine = met.where("near").select("band", "h", "k", F.lit(c).alias("c"))
        ties = met.where("near AND k <> p").select(F.col("p").alias("a"), F.col("k").alias("b"))
        classed = mine if classed is None else classed.unionByName(mine)
        edges = ties if edges is None else edges.unionByName(ties)
        rest = met.where("NOT coalesce(near, false)").select("band", "h", "k")
    left = rest.withColumn("c", F.lit(0))
    return (left if classed is None else classed.unionByName(left)), edges


def _batches(bands: int, signatures: int) -> list[range]:
    """Bands that are worked through together: all where there are few signatures, else one, then twice as many each time."""
    if signatures * bands <= AT_ONCE:
        return [range(bands)]
    ends = [0, *(e for e in (2**n - 1 for n in range(1, bands)) if 2 * e < bands), bands]
    return [range(x, y) for x, y in zip(ends, ends[1:], strict=False)]


def links(signatures: DataFrame, key: str, threshold: float, bands: int, permutations: int, within: Sequence[str] = (), bucket: int | None = None) -> DataFrame:
    """(a, b): edges whose components are those of all pairs of different signatures that agree on a band and whose estimate reaches the threshold.

    Equal signatures are one class: the smallest key stands for it, so that a group of copies costs no pairs. Only rows that
    are equal in the columns of ``within`` are compared. Of many signatures the bands are worked through in batches: a bucket whose members
    earlier bands have joined to one component has nothing to add and sends no signature, and edges are between components, each named by its
    smallest key."""
    rows = permutations // bands
    if rows * bands != permutations:
        raise ValueError("bands must divide the signature")
    spark, bucket = signatures.sparkSession, bucket or BUCKET
    ship(spark)
    # Minima are unsigned numbers of 32 bits; as signed ones they travel in half the bytes.
    narrow = F.transform("signature", lambda x: (x - 2**31).cast("int")).alias("s")
    one = staged(signatures.select(key, *within, narrow).groupBy("s", *within).agg(F.min(key).alias("k")), "signature-classes")
    batches = _batches(bands, one.count())
    found, joined = None, None  # joined(k, o): the component of keys that are not their component's smallest
    for n, some in enumerate(batches):
        parts = F.array(*[F.struct(F.lit(b).alias("band"), F.xxhash64(F.slice("s", b * rows + 1, rows), *within).alias("h")) for b in some])
        each = one.select("k", F.explode(parts).alias("x")).select("k", "x.band", "x.h")
        each = each.withColumn("o", F.col("k")) if joined is None else each.join(joined, "k", "left").withColumn("o", F.coalesce("o", "k"))
        edges = _met(each, one, threshold, bucket, joined is not None)
        if len(batches) > 1:
            edges = staged(edges, "component-edges")
        found = edges if found is None else found.unionByName(edges)
        if n + 1 < len(batches):
            moved = connected_components(edges, "a", "b").where("node <> component").select(F.col("node").cast(one.schema["k"].dataType).alias("k"), F.col("component").cast(one.schema["k"].dataType).alias("o"))
            if joined is not None:
                before = joined.join(moved.select(F.col("k").alias("o"), F.col("o").alias("to")), "o", "left").select("k", F.coalesce("to", "o").alias("o"))
                moved = before.unionByName(moved)
            joined = staged(moved, "components")
    return found


def _met(each: DataFrame, one: DataFrame, threshold: float, bucket: int, later: bool) -> DataFrame:
    """each(k, band, h, o) -> (a, b): ties between components o, by the members of buckets of several components.

    A bucket of at most ``bucket`` members is compared in one go. Of one that is larger, the component with most members (in a later batch) is one
    class, and the others are first tied to pivots: those of one pivot's class are joined by it and are not compared again. What
    is left is exact: rest with all and class with class, in pairs of blocks that are tasks of their own. A task holds
    two blocks, and sends back a row for each linked member instead of the pairs."""
    sizes = staged(each.groupBy("band", "h").agg(F.count("*").alias("n"), F.min("o").alias("lo"), F.max("o").alias("hi")).where("lo <> hi").select("band", "h", "n"), "bucket-sizes")
    small = each.join(sizes.where(F.col("n") <= bucket).select("band", "h"), ["band", "h"])
    placed = small.select("band", "h", F.lit("").alias("i"), F.lit("").alias("j"), F.lit("").alias("mine"), "k", "o")
    edges = None
    if not sizes.where(F.col("n") > bucket).isEmpty():
        hot = staged(each.join(sizes.where(F.col("n") > bucket).select("band", "h"), ["band", "h"]), "hot-buckets")
        largest = None
        if later:
            most = hot.groupBy("band", "h", "o").agg(F.count("*").alias("n")).groupBy("band", "h").agg(F.max_by("o", "n").alias("most"))
            hot = staged(hot.join(most, ["band", "h"]), "hot-components")
            largest, hot = hot.where("o = most").select("band", "h", "k", F.lit(-1).alias("c")), hot.where("o <> most").drop("most")
        members, edges = _pivoted(hot.select("band", "h", "k"), one, threshold, bucket)
        members = staged(members if largest is None else members.unionByName(largest), "hot-members")
        held = members.groupBy("band", "h", "c").agg(F.count("*").alias("n")).withColumn("blocks", F.ceil(F.col("n") / (bucket // 2)))
        blocks = staged(held.select("band", "h", "c", "blocks", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("block")).withColumn("mine", F.concat_ws(".", "c", "block")), "hot-blocks")
        x, y = blocks.select("band", "h", F.col("c").alias("cx"), F.col("mine").alias("i")), blocks.select("band", "h", F.col("c").alias("cy"), F.col("mine").alias("j"))
        pairs = x.join(y, ["band", "h"]).where("i <= j AND (cx <> cy OR cx = 0)").select("band", "h", "i", "j")
        sends = pairs.select("band", "h", "i", "j", F.explode(F.array_distinct(F.array("i", "j"))).alias("mine"))
        owned = each.select("k", "o").distinct()
        dealt = members.join(held.select("band", "h", "c", "blocks"), ["band", "h", "c"]).withColumn("mine", F.concat_ws(".", "c", F.pmod(F.xxhash64("k", "band"), "blocks"))).join(owned, "k")
        placed = placed.unionByName(dealt.join(sends, ["band", "h", "mine"]).select("band", "h", "i", "j", "mine", "k", "o"))
        if edges is not None:
            a, b = owned.select(F.col("k").alias("a"), F.col("o").alias("_a")), owned.select(F.col("k").alias("b"), F.col("o").alias("_b"))
            edges = edges.join(a, "a").join(b, "b").select(F.col("_a").alias("a"), F.col("_b").alias("b")).where("a <> b")
    kind = one.schema["k"].dataType.simpleString()

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[pa.RecordBatch] = []

        def done(some: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            """Whole groups that follow each other."""
            table = pa.Table.from_batches(some).combine_chunks()
            k, s = table.column("o").to_numpy(), table.column("s").combine_chunks().flatten().to_numpy().reshape(table.num_rows, -1)
            side, i, j = (table.column(c).to_numpy() for c in ("mine", "i", "j"))
            first = _edges(table)
            out = [forest_of(k[a:b], s[a:b], side[a:b], threshold, i[a] == j[a]) for a, b in zip(first, [*first[1:], len(k)], strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([o[n] for o in out]), table.schema.field("o").type) for n in (0, 1)], names=["a", "b"])

        for batch in batches:
            if not batch.num_rows:
                continue
            if waiting and not _same(waiting[-1], batch):
                yield from done(waiting)
                waiting = []
            last = int(_edges(pa.Table.from_batches([batch]))[-1])
            if last:
                yield from done([*waiting, batch.slice(0, last)])
                waiting = []
            waiting.append(batch.slice(last))
        if waiting:
            yield from done(waiting)

    by = ("band", "h", "i", "j")
    if later:
        placed = staged(placed, "bucket-members")
        placed = F.broadcast(placed) if placed.count() <= SENT else placed
    wide = placed.join(one.select("k", "s"), "k").repartition(*by).sortWithinPartitions(*by)
    found = wide.select(*by, "mine", "o", "s").mapInArrow(meet, f"a {kind}, b {kind}")
    return found if edges is None else found.unionByName(edges.select(F.col("a").cast(kind), F.col("b").cast(kind)))


def _edges(table: pa.Table) -> np.ndarray:
    """Where groups of (band, h, i, j) begin."""
    new = np.zeros(table.num_rows - 1, bool)
    for c in ("band", "h", "i", "j"):
        v = table.column(c).to_numpy()
        new |= v[1:] != v[:-1]
    return np.flatnonzero(np.append(True, new))


def _same(before: pa.RecordBatch, after: pa.RecordBatch) -> bool:
    """Whether a batch goes on with the group that the one before ended in."""
    return all(before.column(c)[before.num_rows - 1] == after.column(c)[0] for c in ("band", "h", "i", "j"))


def clusters(signatures: DataFrame, key: str, threshold: float, permutations: int, bands: int | None = None, within: Sequence[str] = ()) -> DataFrame:
    """(key, cluster): the smallest key of the documents that chains of estimates at the threshold join, among those equal in ``within``."""
    bands = bands or auto_bands(permutations, threshold)
    joined = connected_components(links(signatures, key, threshold, bands, permutations, within), "a", "b")
    # Equal signatures are told by 128 bits of them, so that they are not moved.
    mark = [F.xxhash64(F.lit(n), "signature").alias(f"_m{n}") for n in range(2)]
    by = ["_m0", "_m1", *within]
    marked = signatures.select(key, *within, *mark)
    heads = marked.groupBy(*by).agg(F.min(key).alias("head"))
    named = heads.join(joined, heads["head"] == joined["node"], "left").select(*by, F.coalesce("component", "head").alias("cluster"))
    return marked.join(named, by).select(key, "cluster")


def exact_groups(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(digest, first, n) of texts that occur more than once."""
    return docs.groupBy(F.sha2(F.col(text), 256).alias("digest")).agg(F.min(key).alias("first"), F.count("*").alias("n")).where("n > 1")
