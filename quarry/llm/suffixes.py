"""Removal of repeated 100-byte strings by suffix sorting of shards with external induction.

A byte is removed if a 100-byte string that covers it also starts earlier (smaller doc_id, or the same document and
an earlier start). All strings that can be equal meet in one shard, whatever documents they are in:

1. Documents become blocks (a row each), staged in the shared folder. Every 100-byte string has an anchor, its
   32-byte string of smallest hash (leftmost of equals), so equal strings have equal anchors. Consecutive
   strings with one anchor make a context: about 35 strings, 134 bytes.
2. A count-min estimate of anchors (as for words, quarry.llm.substring) gives each block one bit for each anchor:
   perhaps in another block. Contexts whose anchor is neither that nor repeated in the block are done.
3. Equal contexts of a block are one: its first place is kept, and all later ones are repeats as a whole.
   Each distinct context goes to the shard of its anchor with its first place. Shards are sent in groups, as one
   message from a block, so that messages do not grow with blocks times shards.
4. A group's task parts the messages into shards, in a file of its own beyond a bound, and takes shard by shard. Of
   a shard it takes each distinct context once and sorts the suffixes of their concatenation with common
   prefixes (quarry.llm.induced). Neighbours that share 100 bytes are equal strings; the earliest place of each
   class is known, and each sent context gets back one bit for each of its strings: starts earlier elsewhere.
5. Each block removes covered bytes.

An anchor may stand in many documents between differing text, so that its contexts are all distinct and all in
one shard. Blocks therefore send, with their anchors, how many distinct contexts each has there beyond the first.
An anchor whose sum passes HOT_CONTEXTS is split in all blocks: each of its strings goes to a shard of strings
by its own 128-bit hash, which equal strings share, and is compared there by that hash. The number of these shards
follows the number of such strings.

A context or string that stands in a third of all documents costs an entry for each block. Nothing is broadcast;
no task holds more than one block, band or shard, and of a group the places of its contexts.

Defined results for odd input: null and empty texts have no bytes; documents of fewer than 100 bytes lose nothing;
rows with the same doc_id count as one document by start (equal starts do not remove each other); a null doc_id
counts as larger than all others; an empty table gives no rows; other columns are passed over.
"""

from __future__ import annotations

import hashlib
import itertools
import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm.induced import HELD, suffix_array
from quarry.llm.substring import _R1, _R2, NULL_ID, TASK_BYTES, coded, decoded, distinct, grouped, mixed, one_by_one, packed, unpacked
from quarry.session import drop_staged, release, scratch, ship, shuffles_removed, staged, table

LENGTH = 100
GRAM = 32
#: Bytes of a block, and of whole documents in it whose contexts are found at once.
BLOCK_BYTES, PIECE_BYTES = 4_000_000, 128_000
#: Bytes of contexts that one shard should hold (its task reads them at once, and gives all strings their classes), and the least number of shards (as a power of two).
SHARD_BYTES, SHARD_BITS = 8_000_000, 7
#: Bytes of contexts that one group of shards should hold; there are as many groups as shards until shards are more than the least number.
GROUP_BYTES = 64_000_000
#: Distinct contexts of an anchor, beyond one a block, from which it is split.
HOT_CONTEXTS = 8192
#: Strings of split anchors that one shard of strings should hold; these shards have the same least number.
SHARD_STRINGS = 2_000_000
#: Anchors that one band's task may merge, the least number of bands, and log2 of the cells of a row of the largest count-min table.
BAND_ANCHORS, BANDS, CELL_BITS = 16_000_000, 64, 26
_R = np.uint64(0x9E3779B97F4A7C15)


def count_min(parts: list[np.ndarray]) -> list[np.ndarray]:
    """For each part's hashes, whether the count-min estimate over all parts is at least two."""
    total = max(1, sum(map(len, parts)))
    bits = min(CELL_BITS, max(10, int(np.ceil(np.log2(total * 8)))))
    shift = np.uint64(64 - bits)
    cells = lambda v, r: (v.astype(np.uint64) * r) >> shift
    flags = []
    for r in (_R1, _R2):
        once, twice = np.zeros(1 << bits, bool), np.zeros(1 << bits, bool)
        for part in parts:
            c = cells(part, r)
            twice[c] |= once[c]
            once[c] = True
        flags.append([twice[cells(part, r)] for part in parts])
        del once, twice
    return [a & b for a, b in zip(*flags, strict=True)]


def band_bits(total_bytes: int) -> int:
    """log2 of the number of bands: so many that a band holds BAND_ANCHORS at most (an anchor for about 35 bytes)."""
    return int(np.ceil(np.log2(max(BANDS, total_bytes / 35 / BAND_ANCHORS))))


def to_blocks(docs: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """docs(doc_id, text) -> (block, ids, nulls, lengths, size, bytes): the documents' UTF-8, one after another."""
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId() << 28
        ids: list = []
        texts: list[bytes] = []
        size = 0

        def done() -> pa.RecordBatch:
            known = np.array([NULL_ID if i is None else i for i in ids], np.int64)
            row = {"block": block, "ids": known.tobytes(), "nulls": np.packbits([i is None for i in ids]).tobytes(), "lengths": np.array([len(t) for t in texts], np.int64).tobytes(), "size": size, "bytes": packed(b"".join(texts))}
            return pa.RecordBatch.from_pylist([row], pa.schema([("block", pa.int64()), ("ids", pa.binary()), ("nulls", pa.binary()), ("lengths", pa.binary()), ("size", pa.int64()), ("bytes", pa.binary())]))

        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                raw = (text or "").encode("utf-8", "surrogatepass")
                ids.append(doc_id)
                texts.append(raw)
                size += len(raw)
                if size >= block_bytes:
                    yield done()
                    block, ids, texts, size = block + 1, [], [], 0
        if ids:
            yield done()

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, "block long, ids binary, nulls binary, lengths binary, size long, bytes binary")


def contexts(data: bytes, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """First string's place in the block, number of strings, document and anchor hash of every context."""
    ends = np.cumsum(lengths)
    found, d, at = [], 0, 0
    while d < len(lengths) or not found:
        e = max(d + 1, int(np.searchsorted(ends, at + PIECE_BYTES)))
        end = int(ends[min(e, len(ends)) - 1]) if len(ends) else 0
        first, count, doc, h = _contexts(data[at:end], lengths[d:e])
        found.append((first + at, count, doc + d, h))
        d, at = e, end
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def _contexts(data: bytes, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    raw = np.frombuffer(data, np.uint8)
    n = len(raw) - LENGTH + 1
    nothing = np.zeros(0, np.int64)
    if n <= 0:
        return nothing, nothing, nothing, np.zeros(0, np.uint64)
    h, power = raw + np.uint64(1), _R
    width = 1
    while width < GRAM:
        h = h[: len(h) - width] * power + h[width:]
        power = np.uint64(pow(int(power), 2, 2**64))
        width *= 2
    h = mixed(h)
    # The least upper half of the hash over the strings' grams, leftmost of equals: the place stands below it. The halves
    # are the same in any block, so that equal strings have equal anchors whatever their blocks' sizes.
    if len(h) >> 32:
        raise ValueError("a document of 4 GB or more")
    low = np.uint64(0xFFFFFFFF)
    key = (h & ~low) | np.arange(len(h), dtype=np.uint64)
    span, width = LENGTH - GRAM + 1, 1
    least = key
    while 2 * width <= span:
        least = np.minimum(least[: len(least) - width], least[width:])
        width *= 2
    if width < span:
        least = np.minimum(least[: len(least) - (span - width)], least[span - width :])
    anchor = (least & low).astype(np.int64)
    ends = np.cumsum(lengths)
    doc = np.repeat(np.arange(len(lengths)), lengths)[:n]
    whole = np.arange(n) + LENGTH <= ends[doc]
    new = np.ones(n, bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (doc[1:] != doc[:-1])
    first = np.flatnonzero(new & whole)
    if not len(first):
        return nothing, nothing, nothing, np.zeros(0, np.uint64)
    # A run of strings ends where the next begins or where its document has no more.
    run = np.cumsum(new) - 1
    count = np.bincount(run[whole], minlength=int(run[-1]) + 1)
    # Least hashes crowd near zero: mixed again, they spread evenly over bands and shards.
    return first, count[run[first]], doc[first], mixed(h[anchor[first]] ^ _R)


def _chosen(data: bytes, first: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """128-bit hashes of contexts."""
    of, view = xxhash.xxh3_128_digest, memoryview(data)
    both = np.frombuffer(b"".join([of(view[a:b]) for a, b in zip(first.tolist(), (first + count + LENGTH - 1).tolist(), strict=True)]), "<u8").reshape(-1, 2)
    return both[:, 0], both[:, 1]


def _ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """All numbers of ranges, one range after another."""
    return np.arange(sizes.sum()) + np.repeat(starts - (np.cumsum(sizes) - sizes), sizes)


def crowds(data: bytes, first: np.ndarray, count: np.ndarray, q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Anchors with several contexts in the block, sorted, and their numbers of contexts beyond the first (many: of distinct ones)."""
    order = np.argsort(q, kind="stable")
    edges = np.flatnonzero(np.append(True, q[order][1:] != q[order][:-1])) if len(q) else np.zeros(0, np.int64)
    size = np.diff(np.append(edges, len(q)))
    values, more = q[order[edges]], size - 1
    for k in np.flatnonzero(size > 8):
        at = order[edges[k] : edges[k] + size[k]]
        more[k] = len(set(zip(*(x.tolist() for x in _chosen(data, first[at], count[at])), strict=True))) - 1
    return values[more > 0], more[more > 0]


def split_anchors(blobs: list[bytes | None], bound: int) -> tuple[np.ndarray, int]:
    """Sorted anchors of a band whose contexts beyond the first of each block pass the bound, and the sum of these contexts. blobs: numbers from crowds()."""
    both = [np.frombuffer(unpacked(x), np.uint32).reshape(2, -1) for x in blobs if x is not None]
    if not both:
        return np.zeros(0, np.uint32), 0
    values, back = np.unique(np.concatenate([x[0] for x in both]), return_inverse=True)
    sums = np.bincount(back, np.concatenate([x[1] for x in both]))
    return values[sums > bound], int(sums[sums > bound].sum())


def _later(keys: tuple[np.ndarray, ...], doc: np.ndarray, start: np.ndarray) -> np.ndarray:
    """For every place, whether one with equal keys is earlier."""
    by = np.lexsort((start, doc, *keys))
    new = np.ones(len(by), bool)
    new[1:] = np.logical_or.reduce([k[by][1:] != k[by][:-1] for k in keys])
    head = by[np.maximum.accumulate(np.where(new, np.arange(len(by)), 0))]
    later = np.empty(len(by), bool)
    later[by] = (doc[by] != doc[head]) | (start[by] != start[head])
    return later


def _later_in(klass: np.ndarray, classes: int, doc: np.ndarray, start: np.ndarray) -> np.ndarray:
    """The same for numbered classes: the least document of each, and its least start, without a sort."""
    first = np.full(classes, np.iinfo(np.int64).max)
    np.minimum.at(first, klass, doc)
    lead = doc == first[klass]
    least = np.full(classes, np.iinfo(np.int64).max)
    np.minimum.at(least, klass[lead], start[lead])
    return ~lead | (start != least[klass])


def string_answers(parts: list[np.ndarray]) -> list[np.ndarray]:
    """For each sender (rows of two halves of hashes, ids, starts): for every string, whether it starts earlier elsewhere."""
    a, b, doc, start = np.concatenate(parts, axis=1)
    return np.split(_later((b, a), doc, start), np.cumsum([p.shape[1] for p in parts])[:-1])


def shard_answers(parts: list[tuple[np.ndarray, np.ndarray, np.ndarray, bytes]]) -> list[np.ndarray]:
    """For each sender (ids, starts, counts of strings, the contexts' bytes): for every string, whether it starts earlier elsewhere."""
    ids, starts, counts = (np.concatenate([p[k] for p in parts]) for k in range(3))
    sizes = counts + LENGTH - 1
    index: dict[bytes, int] = {}
    which = np.empty(len(ids), np.int64)
    k = 0
    for _, _, c, data in parts:
        at = np.concatenate(([0], np.cumsum(c + LENGTH - 1))).tolist()
        for i in range(len(c)):
            which[k] = index.setdefault(data[at[i] : at[i + 1]], len(index))
            k += 1
    # Each distinct context once, parted by a symbol below all bytes.
    text = np.frombuffer(b"".join(x + b"\0" for x in index), np.uint8).astype(np.uint16) + np.uint16(1)
    size = np.array([len(x) for x in index], np.int64)
    ends = np.cumsum(size + 1) - 1
    text[ends] = 0
    begin = ends - size
    index.clear()
    order, lcp = suffix_array(text, 257, LENGTH)
    own = np.repeat(np.arange(len(size)), size + 1)
    real = order + LENGTH <= ends[own[order]]
    group = np.cumsum(~((lcp >= LENGTH) & real)) - 1
    of = np.full(len(text), -1, np.int64)
    of[order[real]] = group[real]
    classes = int(group[-1]) + 1
    del order, lcp, real, group
    # The class of every string that was sent, and the earliest place of each class.
    klass = of[_ranges(begin[which], counts)]
    doc, start = np.repeat(ids, counts), _ranges(starts, counts)
    return np.split(_later_in(klass, classes, doc, start), np.cumsum([int(p[2].sum()) for p in parts])[:-1])


def group_answers(messages: Iterator[tuple[int, int, bytes]], shards: int, held: int = HELD) -> tuple[list[int], list[np.ndarray]]:
    """Senders, and shard_answers() for the contexts of each, one shard of the group after another.

    A message: sender, number of contexts, and as bytes the numbers of contexts by shard, then ids, starts and counts of strings, then the contexts' bytes."""
    senders, numbers, cuts, places = [], [], [], []
    with tempfile.SpooledTemporaryFile(held) as file:
        for sender, n, blob in messages:
            cut = np.concatenate(([0], np.cumsum(np.frombuffer(blob, np.int64, shards))))
            three = np.frombuffer(blob, np.int64, 3 * n, 8 * shards).reshape(3, n).copy()
            sizes = np.concatenate(([0], np.cumsum(three[2] + LENGTH - 1)))
            senders.append(sender)
            numbers.append(three)
            cuts.append(cut)
            places.append(file.tell() + sizes[cut])
            file.write(memoryview(blob)[8 * (shards + 3 * n) :])
        answers: list[list[np.ndarray]] = [[] for _ in senders]
        for k in range(shards):
            some = [m for m, cut in enumerate(cuts) if cut[k + 1] > cut[k]]
            parts = []
            for m in some:
                file.seek(int(places[m][k]))
                parts.append((*numbers[m][:, cuts[m][k] : cuts[m][k + 1]], file.read(int(places[m][k + 1] - places[m][k]))))
            for m, later in zip(some, shard_answers(parts) if parts else [], strict=True):
                answers[m].append(later)
    return senders, [np.concatenate(x) for x in answers]


def remove_repeats(docs: DataFrame, block_bytes: int = BLOCK_BYTES, hot: int = HOT_CONTEXTS) -> DataFrame:
    """docs(doc_id, text) -> doc_id, n_bytes, n_removed, n_spans, kept (bytes left), kept_sha256."""
    spark = docs.sparkSession
    ship(spark)
    with shuffles_removed(spark):
        return _remove_repeats(spark, docs, block_bytes, hot)


def _remove_repeats(spark: SparkSession, docs: DataFrame, block_bytes: int, hot: int) -> DataFrame:
    block_path = scratch(spark, "byte-blocks")
    to_blocks(docs, block_bytes).write.option("compression", "none").parquet(block_path)
    blocks = spark.read.parquet(block_path)
    total = blocks.agg(F.sum("size")).first()[0] or 0
    lb = band_bits(total)
    sb = max(SHARD_BITS, int(np.ceil(np.log2(max(1, total / SHARD_BYTES)))))
    gb = max(SHARD_BITS, int(np.ceil(np.log2(max(1, total / GROUP_BYTES)))))
    sb = max(sb, gb)
    drop = np.uint64(32 - lb)
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // TASK_BYTES))

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in one_by_one(batch):
                data = unpacked(row["bytes"])
                first, count, _, h = contexts(data, np.frombuffer(row["lengths"], np.int64))
                q = distinct(h >> drop)
                values, more = crowds(data, first, count, h >> drop)
                ends = np.searchsorted((values >> np.uint64(32)).astype(np.int64), np.arange((1 << lb) + 1))
                edges = np.searchsorted((q >> np.uint64(32)).astype(np.int64), np.arange((1 << lb) + 1))
                some = np.flatnonzero(np.diff(edges))
                blobs = [coded((q[edges[b] : edges[b + 1]] & np.uint64(0xFFFFFFFF)).astype(np.uint32)) for b in some]
                many = [packed(np.stack((values[i:j] & np.uint64(0xFFFFFFFF), more[i:j].astype(np.uint64))).astype("<u4").tobytes()) if j > i else None for i, j in zip(ends[some], ends[some + 1], strict=True)]
                yield pa.RecordBatch.from_pydict({"band": pa.array(some, pa.int64()), "block": pa.array([row["block"]] * len(some), pa.int64()), "blob": pa.array(blobs, pa.binary()), "more": pa.array(many, pa.binary())})

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for band, rows in grouped(batches, "band"):
            sent = [decoded(r["blob"]) for r in rows]
            marks = count_min(sent)
            split, crowd = split_anchors([r["more"] for r in rows], hot)
            bits = [np.packbits(m).tobytes() for m in marks]
            for k, q in enumerate(sent if len(split) else []):  # a second row of bits where an anchor is split
                found = np.isin(q, split)
                bits[k] += np.packbits(found).tobytes() if found.any() else b""
                crowd += int(found.sum())
            yield pa.RecordBatch.from_pydict({"block": pa.array([r["block"] for r in rows], pa.int64()), "part": pa.array([band] * len(rows), pa.int64()), "blob": pa.array(bits, pa.binary()), "n": pa.array([len(m) for m in marks], pa.int64()), "crowd": pa.array([crowd] + [0] * (len(rows) - 1), pa.int64())})

    sketches = blocks.select("block", "lengths", "bytes").mapInArrow(sketch, "band long, block long, blob binary, more binary")
    marks = staged(sketches.repartition(max(tasks, 1 << lb), "band").sortWithinPartitions("band", "block").mapInArrow(merge, "block long, part long, blob binary, n long, crowd long"), "anchor-estimates")
    release(spark)
    # Contexts of split anchors, of about half as many strings as one can have.
    strings = (marks.agg(F.sum("crowd")).first()[0] or 0) * (LENGTH - GRAM + 1) / 2
    tb = max(SHARD_BITS, int(np.ceil(np.log2(max(1, strings / SHARD_STRINGS)))))

    names = ["kind", "part", "block", "n", "doc_id", "n_bytes", "sha", "blob", "ids", "nulls", "lengths", "bytes"]
    kinds = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary(), pa.binary(), pa.binary(), pa.binary(), pa.binary()]

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(rows: list[dict]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([r.get(c) for r in rows], k) for c, k in zip(names, kinds, strict=True)], names=names)

        for block, rows in grouped(batches, "block"):
            head, answers = rows[0], rows[1:]
            ids, lengths = np.frombuffer(head["ids"], np.int64), np.frombuffer(head["lengths"], np.int64)
            nulls = np.unpackbits(np.frombuffer(head["nulls"], np.uint8), count=len(ids)).astype(bool)
            data = unpacked(head["bytes"])
            begin = np.cumsum(lengths) - lengths
            first, count, doc, h = contexts(data, lengths)
            order = np.argsort(h >> drop, kind="stable")
            new = np.ones(len(h), bool)
            new[1:] = (h[order][1:] >> drop) != (h[order][:-1] >> drop)
            back = np.empty(len(h), np.int64)
            back[order] = np.cumsum(new) - 1
            bits = [np.frombuffer(r["blob"], np.uint8) for r in answers]
            mark = np.concatenate([np.unpackbits(x, count=r["n"]).astype(bool) for x, r in zip(bits, answers, strict=True)]) if answers else np.zeros(0, bool)
            cut = np.concatenate([np.unpackbits(x[-(-r["n"] // 8) :], count=r["n"]).astype(bool) if len(x) > -(-r["n"] // 8) else np.zeros(r["n"], bool) for x, r in zip(bits, answers, strict=True)]) if answers else np.zeros(0, bool)
            if len(mark) != new.sum():
                raise ValueError(f"block {block}: {int(new.sum())} anchors, {len(mark)} answers")
            keep = (mark | (np.bincount(back, minlength=len(mark)) > 1))[back] if len(mark) else np.zeros(0, bool)
            split = cut[back][keep]
            first, count, doc, h = first[keep], count[keep], doc[keep], h[keep]
            busy = np.zeros(len(ids), bool)
            busy[doc] = True
            free = np.flatnonzero(~busy)
            for s in range(0, len(free), 1000):
                some = []
                for d in free[s : s + 1000]:
                    text = data[begin[d] : begin[d] + lengths[d]]
                    some.append({"kind": "r", "block": block, "doc_id": None if nulls[d] else int(ids[d]), "n_bytes": len(text), "sha": hashlib.sha256(text).hexdigest(), "bytes": text})
                yield out(some)
            if not len(first):
                continue
            # Distinct contexts, each with its earliest place; entries in the order of shard, then hash. Strings of split anchors are contexts of one string.
            whole = ~split
            n = count[split]
            first, doc, count = np.concatenate((first[whole], _ranges(first[split], n))), np.concatenate((doc[whole], np.repeat(doc[split], n))), np.concatenate((count[whole], np.ones(n.sum(), np.int64)))
            a, b = _chosen(data, first, count)
            start = first - begin[doc]
            shard = np.concatenate((h[whole] >> np.uint64(64 - sb), np.uint64(1 << sb) + (a[whole.sum() :] >> np.uint64(64 - tb)))).astype(np.int64)
            by = np.lexsort((start, ids[doc], b, a, shard))
            new = np.ones(len(by), bool)
            new[1:] = (a[by][1:] != a[by][:-1]) | (b[by][1:] != b[by][:-1])
            entry = np.empty(len(by), np.int64)
            entry[by] = np.cumsum(new) - 1
            lead = by[new]
            held = np.flatnonzero(busy)
            places = np.searchsorted(held, doc)
            # Equal place and document as the entry's first: the answer counts; otherwise all its strings are repeats.
            same = (ids[doc] == ids[doc[lead]][entry]) & (start == start[lead][entry])
            info = np.concatenate((start, count, places, entry, same.astype(np.int64))).astype("<i8").tobytes()
            text = b"".join(data[begin[d] : begin[d] + lengths[d]] for d in held)
            yield out([{"kind": "t", "block": block, "part": -1, "n": len(first), "ids": ids[held].tobytes(), "nulls": np.packbits(nulls[held]).tobytes(), "lengths": lengths[held].tobytes(), "bytes": packed(text), "blob": packed(info)}])
            # A message to each group of shards, and to each shard of strings.
            shard = shard[lead]
            part = np.where(shard >> sb, shard - (1 << sb) + (1 << gb), shard >> (sb - gb))
            edges = np.searchsorted(part, np.arange((1 << gb) + (1 << tb) + 1))
            sent = []
            for p in np.flatnonzero(np.diff(edges)):
                e = lead[edges[p] : edges[p + 1]]
                if p >> gb:
                    sent.append({"kind": "c", "block": block, "part": int(p), "n": len(e), "blob": packed(np.stack((a[e].view(np.int64), b[e].view(np.int64), ids[doc[e]], start[e])).astype("<i8").tobytes())})
                    continue
                of = np.bincount(shard[edges[p] : edges[p + 1]] & ((1 << sb - gb) - 1), minlength=1 << sb - gb)
                numbers = np.concatenate((of, ids[doc[e]], start[e], count[e])).astype("<i8").tobytes()
                sent.append({"kind": "c", "block": block, "part": int(p), "n": len(e), "blob": packed(numbers + b"".join(data[x : x + c + LENGTH - 1] for x, c in zip(first[e].tolist(), count[e].tolist(), strict=True)))})
            yield out(sent)

    none = F.lit(None)
    empty = [none.cast("binary").alias(c) for c in ("ids", "nulls", "lengths", "bytes")]
    text_rows = blocks.select("block", F.lit(-1).cast("long").alias("part"), none.cast("binary").alias("blob"), none.cast("long").alias("n"), "ids", "nulls", "lengths", "bytes")
    chosen = text_rows.unionByName(marks.select("block", "part", "blob", "n", *empty)).repartition(tasks, "block").sortWithinPartitions("block", "part").mapInArrow(choose, "kind string, part long, block long, n long, doc_id long, n_bytes long, sha string, blob binary, ids binary, nulls binary, lengths binary, bytes binary")
    path = scratch(spark, "contexts")
    chosen.write.option("compression", "lz4").partitionBy("kind").parquet(path)
    drop_staged(spark, block_path)
    release(spark)
    stored = spark.read.schema("part long, block long, n long, doc_id long, n_bytes long, sha string, blob binary, ids binary, nulls binary, lengths binary, bytes binary, kind string").parquet(path)

    def sort_shard(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (r for batch in batches for r in one_by_one(batch))
        for part, own in itertools.groupby(rows, lambda r: r["part"]):
            messages = ((r["block"], r["n"], unpacked(r["blob"])) for r in own)
            if part >> gb:
                senders, parts = [], []
                for sender, n, blob in messages:
                    senders.append(sender)
                    parts.append(np.frombuffer(blob, np.int64).reshape(4, n))
                later = string_answers(parts)
            else:
                senders, later = group_answers(messages, 1 << sb - gb)
            yield pa.RecordBatch.from_pydict({"block": pa.array(senders, pa.int64()), "part": pa.array([part] * len(senders), pa.int64()), "blob": pa.array([np.packbits(x).tobytes() for x in later], pa.binary()), "n": pa.array([len(x) for x in later], pa.int64())})

    sent = stored.where("kind = 'c'").select("part", "block", "n", "blob")
    answers = staged(sent.repartition(max(tasks, 1 << gb), "part").sortWithinPartitions("part", "block").mapInArrow(sort_shard, "block long, part long, blob binary, n long"), "string-answers")
    release(spark)

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, rows in grouped(batches, "block"):
            head, got = rows[0], rows[1:]
            ids, lengths = np.frombuffer(head["ids"], np.int64), np.frombuffer(head["lengths"], np.int64)
            nulls = np.unpackbits(np.frombuffer(head["nulls"], np.uint8), count=len(ids)).astype(bool)
            raw = np.frombuffer(unpacked(head["bytes"]), np.uint8)
            begin = np.cumsum(lengths) - lengths
            start, count, doc, entry, same = np.frombuffer(unpacked(head["blob"]), np.int64).reshape(5, head["n"])
            bits = np.concatenate([np.unpackbits(np.frombuffer(r["blob"], np.uint8), count=r["n"]).astype(bool) for r in got])
            width = np.zeros(int(entry.max()) + 1, np.int64)
            width[entry] = count
            if width.sum() != len(bits):
                raise ValueError(f"block {head['block']}: {int(width.sum())} strings, {len(bits)} answers")
            offset = np.cumsum(width) - width
            gone = bits[_ranges(offset[entry], count)] | np.repeat(same == 0, count)
            at = _ranges(begin[doc] + start, count)[gone]
            edge = np.zeros(len(raw) + 1, np.int64)
            np.add.at(edge, at, 1)
            np.add.at(edge, at + LENGTH, -1)
            cut = np.cumsum(edge[:-1]) > 0
            kept, sizes, removed, spans, shas, texts = [], [], [], [], [], []
            for d in range(len(ids)):
                a, b = int(begin[d]), int(begin[d] + lengths[d])
                c = cut[a:b]
                left = raw[a:b][~c].tobytes()
                sizes.append(b - a)
                removed.append(int(c.sum()))
                spans.append(int(c[:1].sum() + (c[1:] & ~c[:-1]).sum()))
                shas.append(hashlib.sha256(left).hexdigest())
                texts.append(left)
                kept.append(None if nulls[d] else int(ids[d]))
            yield pa.RecordBatch.from_arrays([pa.array(kept, pa.int64()), pa.array(sizes, pa.int64()), pa.array(removed, pa.int64()), pa.array(spans, pa.int64()), pa.array(texts, pa.binary()), pa.array(shas, pa.string())], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept", "kept_sha256"])

    text_rows = stored.where("kind = 't'").select("block", "part", "blob", "n", "ids", "nulls", "lengths", "bytes")
    cut = text_rows.unionByName(answers.select("block", "part", "blob", "n", *empty)).repartition(tasks, "block").sortWithinPartitions("block", "part").mapInArrow(finish, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary, kept_sha256 string")
    zero = F.lit(0).cast("long")
    whole = stored.where("kind = 'r'").select("doc_id", "n_bytes", zero.alias("n_removed"), zero.alias("n_spans"), F.col("bytes").alias("kept"), F.col("sha").alias("kept_sha256"))
    return whole.unionByName(cut)


def op8_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents")).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
