"""SimHash near-duplicates by meet-in-the-middle ball hashing.

Two fingerprints that differ in at most ``radius`` bits have a common variant within half the radius of
both (radius odd: of one, and within half and one bit of the other). Every distinct fingerprint therefore emits its whole ball of half-radius variants (2,081 for radius 4),
the variants are shuffled, and fingerprints that meet at a variant are verified and linked.

Variants are dealt by a linear map of their bits: variant v belongs to coset L(v), with L(f ^ e) = L(f) ^ L(e).
A fingerprint and a coset therefore determine which of its variants fall there, so the
shuffle carries one 8-byte fingerprint for each coset instead of a row for each variant, and the
receiving task expands and sorts just the variants of its coset (again split by further linear bits, so that
a task never holds more than MEMBERS variants at once, however they crowd). The number of cosets is 256, doubled
until the fingerprints that a coset gets, n x (cosets reached by a ball) / cosets, are at most ROWS_A_COSET.

At a variant all members are within the radius of each other (triangle inequality), so a group is tied to its
smallest member, never expanded to pairs; each tie is verified by its Hamming distance, and each task sends
a spanning forest, so a group of any size costs a row for each member. With an odd radius the smallest of the
members nearer to the variant is taken, if there are any: it is within the radius of all.

Defined results for odd input: null, empty and wordless texts have fingerprint zero, which is linked like any
other; repeated rows share a component; rows with a null doc_id keep a fingerprint and get the component of
equal or near fingerprints, null only if that component has no doc_id; an empty table gives no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.graph import connected_components
from quarry.session import ship, staged, table

RADIUS = 4
SHINGLE = 4
SEED = 42
BITS = 64
COSETS = 256
#: Distinct fingerprints that a task of one coset may hold (8 bytes each, twice while it sorts).
ROWS_A_COSET = 16_000_000
#: Variants expanded at once in a task.
MEMBERS = 4_000_000
#: Bits of the linear map that may be used.
LINEAR = 40
#: Bits of a position among the variants expanded at once.
INDEX_BITS = 24

_LOWER = bytes((c | 0x20) if 0x41 <= c <= 0x5A else c for c in range(256))
_WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def shingle_hashes(text: str | None, size: int = SHINGLE) -> np.ndarray:
    """XXH64 of every shingle, repeats included."""
    words = _WORD.findall((text or "").encode("utf-8", "surrogatepass").translate(_LOWER))
    if not words:
        return np.empty(0, np.uint64)
    digest = xxhash.xxh64_intdigest
    if len(words) <= size:
        return np.array([digest(b" ".join(words), SEED)], np.uint64)
    # Each shingle is a slice of the words joined by single spaces.
    line = b" ".join(words)
    edges = np.concatenate(([0], np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)))
    begins, ends = edges[: len(words) - size + 1].tolist(), (edges[size:] - 1).tolist()
    return np.array([digest(line[a:b], SEED) for a, b in zip(begins, ends, strict=True)], np.uint64)


def fingerprint(text: str | None) -> int:
    h = shingle_hashes(text)
    if not len(h):
        return 0
    counts = np.zeros(BITS, np.int64)
    for s in range(0, len(h), 128):  # sums of at most 128 bits fit a byte
        part = np.unpackbits(h[s : s + 128].astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
        counts += np.add.reduce(part, axis=0, dtype=np.uint8)
    return int.from_bytes(np.packbits(counts * 2 > len(h)).tobytes(), "big")


def fingerprints(docs: DataFrame, *also: str) -> DataFrame:
    """docs(doc_id, text) -> doc_id, fp (the fingerprint as a signed long) and other columns of longs; one narrow pass over whole texts."""
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([fingerprint(x) for x in batch.column("text").to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found.view(np.int64)), *map(batch.column, also)], names=["doc_id", "fp", *also])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), *also).mapInArrow(run, ", ".join(f"{c} long" for c in ("doc_id", "fp", *also)))


def ball(radius: int) -> np.ndarray:
    """All masks of at most radius bits."""
    ones = np.uint64(1) << np.arange(BITS, dtype=np.uint64)
    masks = [np.zeros(1, np.uint64)]
    level = [(np.uint64(0), -1)]
    for _ in range(radius):
        level = [(m | ones[j], j) for m, last in level for j in range(last + 1, BITS)]
        masks.append(np.array([m for m, _ in level], np.uint64))
    return np.concatenate(masks)


def linear(values: np.ndarray, bits: int) -> np.ndarray:
    """A linear map over GF(2) to bits bits: parities of fixed pseudo-random masks."""
    rng = np.random.default_rng(20240607)
    rows = rng.integers(0, 2**63, LINEAR, dtype=np.uint64) * np.uint64(2) + rng.integers(0, 2, LINEAR, dtype=np.uint64)
    out = np.zeros(len(values), np.int64)
    for k in range(bits):
        out |= (np.bitwise_count(values & rows[k]).astype(np.int64) & 1) << k
    return out


def forest(nodes: np.ndarray, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of an edge list over positions 0..len(nodes)-1: each linked node with its root."""
    root = np.arange(len(nodes))
    while len(left):
        a, b = root[left], root[right]
        apart = a != b
        left, right, a, b = left[apart], right[apart], a[apart], b[apart]
        if not len(left):
            break
        np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
        while True:
            up = root[root]
            if (up == root).all():
                break
            root = up
    child = np.flatnonzero(root != np.arange(len(nodes)))
    return child, root[child]


def meet(fps: np.ndarray, coset: int, bits: int, radius: int, members: int = MEMBERS) -> tuple[np.ndarray, np.ndarray]:
    """Links among sorted distinct fingerprints whose common variants lie in one coset, as a spanning forest."""
    masks = ball((radius + 1) // 2)
    of_mask, of_fp = linear(masks, LINEAR), linear(fps, LINEAR)
    by_low: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    left, right = [], []
    start = min(LINEAR, bits + max(0, int(np.ceil(np.log2(max(1, len(fps) * len(masks) / 2**bits / members))))))
    todo = [(coset | (sub << bits), start) for sub in range(2 ** (start - bits))]
    while todo:
        target, k = todo.pop()
        if k not in by_low:
            low = of_mask & ((1 << k) - 1)
            order = np.argsort(low, kind="stable")
            by_low[k] = masks[order], low[order]
        sorted_masks, low = by_low[k]
        need = (of_fp & ((1 << k) - 1)) ^ target
        lo, hi = np.searchsorted(low, need), np.searchsorted(low, need, "right")
        n = hi - lo
        if n.sum() > 2 * members and k < LINEAR:  # variants crowd here: split by one more bit
            todo += [(target, k + 1), (target | (1 << k), k + 1)]
            continue
        who = np.repeat(np.arange(len(fps)), n)
        which = np.arange(len(who)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(lo, n)
        variants = fps[who] ^ sorted_masks[which]
        if len(variants) >> INDEX_BITS:
            raise ValueError("one variant has too many members")  # at 40 bits only fingerprints of one ball are left
        # A sort of 40 hashed bits with the position below them finds what may meet; only that is sorted exactly.
        low = np.uint64((1 << INDEX_BITS) - 1)
        keys = np.sort(((variants * np.uint64(0x9E3779B97F4A7C15)) & ~low) | np.arange(len(variants), dtype=np.uint64))
        same = (keys[1:] & ~low) == (keys[:-1] & ~low)
        may = np.concatenate((same, [False])) | np.concatenate(([False], same)) if len(keys) else np.zeros(0, bool)
        at = (keys[may] & low).astype(np.int64)
        variants, who = variants[at], who[at]
        nearer = (np.bitwise_count(variants ^ fps[who]) > radius // 2,) if radius % 2 else ()
        by = np.lexsort((who, *nearer, variants))
        variants, who = variants[by], who[by]
        if not len(who):
            continue
        head = np.append(True, variants[1:] != variants[:-1])
        first = who[np.maximum.accumulate(np.where(head, np.arange(len(who)), 0))]
        tied = ~head
        a, b = first[tied], who[tied]
        near = np.bitwise_count(fps[a] ^ fps[b]) <= radius
        child, root = forest(fps, a[near], b[near])
        left.append(child)
        right.append(root)
    if not left:
        return fps[:0], fps[:0]
    child, root = forest(fps, np.concatenate(left), np.concatenate(right))
    return fps[child], fps[root]


def coset_bits(n: int, radius: int = RADIUS, rows: int = ROWS_A_COSET) -> int:
    """log2 of the number of cosets, so that one gets at most rows of n distinct fingerprints."""
    masks, bits = ball((radius + 1) // 2), int(np.log2(COSETS))
    while bits < LINEAR and n * len(np.unique(linear(masks, bits))) / 2**bits > rows:
        bits += 1
    return bits


def near_links(distinct: DataFrame, radius: int = RADIUS) -> DataFrame:
    """distinct(fp) -> (src, dst): forests over true links, which together join all that chains of links within the radius join."""
    spark = distinct.sparkSession
    ship(spark)
    bits = coset_bits(distinct.count(), radius)

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reach = np.unique(linear(ball((radius + 1) // 2), bits))
        for batch in batches:
            f = np.sort(batch.column("fp").to_numpy().view(np.uint64))
            if not len(f):
                continue
            at = linear(f, bits)
            if len(reach) == 2**bits:  # every fingerprint has variants in every coset
                blob = f.tobytes()
                for c in range(2**bits):
                    yield pa.RecordBatch.from_pydict({"coset": pa.array([c], pa.int32()), "fps": pa.array([blob], pa.binary())})
            else:
                cosets = (at[:, None] ^ reach[None, :]).reshape(-1)
                order = np.argsort(cosets, kind="stable")
                values, edges = np.repeat(f, len(reach))[order], np.flatnonzero(np.diff(cosets[order], prepend=-1))
                ends = np.append(edges[1:], len(order))
                yield pa.RecordBatch.from_pydict({"coset": pa.array(cosets[order][edges], pa.int32()), "fps": pa.array([values[a:b].tobytes() for a, b in zip(edges, ends, strict=True)], pa.binary())})

    def collide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[np.ndarray]] = {}
        now = None

        def done(c: int) -> pa.RecordBatch:
            a, b = meet(np.unique(np.concatenate(held.pop(c))), c, bits, radius)
            return pa.RecordBatch.from_pydict({"src": pa.array(a.view(np.int64)), "dst": pa.array(b.view(np.int64))})

        for batch in batches:
            for c, blob in zip(batch.column("coset").to_pylist(), batch.column("fps"), strict=True):
                if c != now and now is not None:
                    yield done(now)
                now = c
                held.setdefault(c, []).append(np.frombuffer(blob.as_buffer(), np.uint64).copy())
        if now is not None:
            yield done(now)

    sent = distinct.select("fp").mapInArrow(emit, "coset int, fps binary")
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 2**bits // 4)
    return sent.repartition(tasks, "coset").sortWithinPartitions("coset").mapInArrow(collide, "src long, dst long")


def roots(distinct: DataFrame, radius: int = RADIUS) -> DataFrame:
    """distinct(fp, first_id) with root: the same for all fingerprints of a component."""
    groups = connected_components(near_links(distinct, radius))
    return distinct.join(groups, distinct["fp"] == groups["node"], "left").select("fp", "first_id", F.coalesce("component", "fp").alias("root"))


def near_duplicates(docs: DataFrame, radius: int = RADIUS) -> DataFrame:
    """docs(doc_id, text) -> doc_id, fingerprint (16 hex digits), component_id (smallest doc_id reachable)."""
    marked = staged(fingerprints(docs), "fingerprints")
    rooted = roots(staged(marked.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "fingerprint-groups"), radius)
    # Staged, so that the join below is dealt anew and a large component's partition can be split.
    least = staged(rooted.groupBy("root").agg(F.min("first_id").alias("component_id")), "components")
    named = rooted.join(least, "root").select("fp", "component_id")
    return marked.join(named, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))
