"""Removal of repeated passages of 13 words with a count-min prefilter.

A window is 13 consecutive words of a document; words covered by a window that also starts in a document
with a smaller doc_id are removed. Six steps, all over blocks of about BLOCK_BYTES of text:

1. Documents become blocks (a row each: ids and words), staged in the shared folder.
2. Each block sends its count-min sketch: of each of two rows the cells that its windows touch, sorted and
   gap-coded (a cell counts a block once; about 2 bytes a window and row). A row has at least 64
   cells for each window of the corpus, so that most texts without repeats are seen to have none, and is
   cut into bands of cells.
3. A band's task merges the sketches of all blocks by adding them up, cell by cell.
   The estimate of a window is the smaller of its two cells and never below the number of blocks
   that hold it. Each block gets back one bit for each cell that it sent: touched by another block too.
4. With these bits a block keeps only windows estimated repeated or repeated in the block itself. Of each,
   hashed to 128 bits, it sends one row with its smallest doc_id: a window that stands in a third of all
   documents costs a row a block.
5. A bucket's task groups these exactly and answers one bit for each: a smaller doc_id has it.
6. Each block removes covered words. Documents without a kept window end at step 4.

Nothing is broadcast, no task holds more than one band, bucket or block, and each step's input is removed once read. Equality of windows
is equality of 128-bit hashes of their bytes.

Defined results for odd input: null and empty texts have no words (hash of the empty string); documents of fewer
than 13 words lose nothing; rows with the same doc_id do not remove each other's words; a null doc_id counts as larger
than all others; an empty table gives no rows; other columns are passed over.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.session import drop_staged, release, scratch, ship, shuffles_removed, staged, table

WINDOW = 13
BLOCK_BYTES = 1_000_000
#: Bytes of blocks that one task reads.
TASK_BYTES = 16_000_000
#: Windows whose cells one band may hold, and log2 of the least number of bands of a row.
BAND_WINDOWS, BAND_BITS = 4_000_000, 6
#: log2 of the cells of a row for each window.
SPARSE = 6
NULL_ID = 2**63 - 1
_R1, _R2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def packed(data: bytes) -> bytes:
    return struct.pack("<Q", len(data)) + zstandard.ZstdCompressor(level=1).compress(data)


def unpacked(blob: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(blob[8:], max_output_size=struct.unpack("<Q", blob[:8])[0]) if len(blob) > 8 else b""


def to_blocks(docs: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """docs(doc_id, text) -> (block, ids, nulls, size, words), compressed: words of a document by single spaces, documents by line ends."""
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId() << 28
        ids: list = []
        texts: list[bytes] = []
        size = 0

        def done() -> pa.RecordBatch:
            known = np.array([NULL_ID if i is None else i for i in ids], np.int64)
            nulls = np.packbits(np.array([i is None for i in ids], bool))
            return pa.RecordBatch.from_pydict({"block": pa.array([block], pa.int64()), "ids": pa.array([known.tobytes()], pa.binary()), "nulls": pa.array([nulls.tobytes()], pa.binary()), "size": pa.array([size], pa.int64()), "words": pa.array([packed(b"\n".join(texts))], pa.binary())})

        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                line = b" ".join((text or "").encode("utf-8", "surrogatepass").split())
                ids.append(doc_id)
                texts.append(line)
                size += len(line) + 1
                if size >= block_bytes:
                    yield done()
                    block, ids, texts, size = block + 1, [], [], 0
        if ids:
            yield done()

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, "block long, ids binary, nulls binary, size long, words binary")


_POWERS: list[np.ndarray] = []
_INVERSE = np.uint64(pow(int(_R1), -1, 2**64))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The multiplier's powers and their inverses modulo 2**64, kept in a worker."""
    if not _POWERS or len(_POWERS[0]) < n:
        size = max(n, 1 << 20)
        _POWERS[:] = [np.cumprod(np.concatenate(([np.uint64(1)], np.full(size - 1, r, np.uint64)))) for r in (_R1, _INVERSE)]
    return _POWERS[0][:n], _POWERS[1][:n]


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return (h ^ (h >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)


def word_ranges(words: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First byte, end and document (index) of every word of a block."""
    parts = np.flatnonzero((words == 32) | (words == 10))
    begin, end = np.concatenate(([0], parts + 1)), np.append(parts, len(words))
    doc = np.concatenate(([0], np.cumsum(words[parts] == 10)))
    real = end > begin
    return begin[real], end[real], doc[real]


def windows(words: bytes, size: int = WINDOW) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """First byte, end, document and first word (index in the document) of every window, and a hash of
    its bytes for the sketch (equal windows have equal hashes)."""
    raw = np.frombuffer(words, np.uint8)
    begin, end, doc = word_ranges(raw)
    n = len(begin) - size + 1
    whole = np.flatnonzero(doc[: max(0, n)] == doc[size - 1 :]) if n > 0 else np.zeros(0, np.int64)
    first = whole - np.searchsorted(doc, doc[whole])
    a, b, doc = begin[whole], end[whole + size - 1], doc[whole]
    up, down = powers(len(raw) + 1)
    sums = np.concatenate(([np.uint64(0)], np.cumsum((raw + np.uint64(1)) * up[: len(raw)])))
    return a, b, doc, first, mixed((sums[b] - sums[a]) * down[a])


def distinct(values: np.ndarray) -> np.ndarray:
    values = np.sort(values)
    return values[np.append(True, values[1:] != values[:-1])] if len(values) else values


def digests(words: bytes, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """128-bit hashes of byte ranges, as two numbers."""
    of, view = xxhash.xxh3_128_digest, memoryview(words)
    both = np.frombuffer(b"".join([of(view[a:b]) for a, b in zip(begin.tolist(), end.tolist(), strict=True)]), "<u8").reshape(-1, 2)
    return both[:, 0].copy(), both[:, 1].copy()


def squeezed(a: np.ndarray, b: np.ndarray, least: np.ndarray) -> bytes:
    """Sorted first hashes by their gaps, second hashes and ids, as compressed byte planes."""
    planes = [np.ascontiguousarray(x.astype("<u8").view(np.uint8).reshape(-1, 8).T) for x in (np.diff(a, prepend=np.uint64(0)), b, least.view(np.uint64))]
    return zstandard.ZstdCompressor(level=1).compress(b"".join(p.tobytes() for p in planes))


def unsqueezed(blob: bytes, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob, max_output_size=24 * n), np.uint8).reshape(3, 8, n)
    a, b, least = (np.ascontiguousarray(p.T).view("<u8").reshape(-1) for p in planes)
    return np.cumsum(a), b, least.view(np.int64)


def coded(values: np.ndarray) -> bytes:
    """Sorted distinct 32-bit numbers as compressed byte planes of their gaps."""
    gaps = np.diff(values.astype(np.int64), prepend=0).astype("<u4")
    planes = np.ascontiguousarray(gaps.view(np.uint8).reshape(-1, 4).T)
    return struct.pack("<I", len(values)) + zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def decoded(blob: bytes) -> np.ndarray:
    n = struct.unpack("<I", blob[:4])[0]
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob[4:], max_output_size=4 * n), np.uint8).reshape(4, n)
    return np.cumsum(np.ascontiguousarray(planes.T).view("<u4").reshape(-1), dtype=np.int64).astype(np.uint32)


def one_by_one(batch: pa.RecordBatch) -> Iterator[dict]:
    """Rows as dicts; a batch of large values is not copied as a whole."""
    for i in range(batch.num_rows):
        yield {c: batch.column(c)[i].as_py() for c in batch.schema.names}


def grouped(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[tuple[int, list[dict]]]:
    """Rows of each key, where rows come sorted by it."""
    now, held = None, []
    for batch in batches:
        for row in one_by_one(batch):
            if row[key] != now and held:
                yield now, held
                held = []
            now = row[key]
            held.append(row)
    if held:
        yield now, held


def sketch_bits(total_bytes: int) -> tuple[int, int]:
    """log2 of the cells of a row (2**SPARSE for each window, at about six bytes a word) and of its bands."""
    windows = max(1, total_bytes / 6)
    bits = max(16, SPARSE + int(np.ceil(np.log2(windows))))
    return bits, max(BAND_BITS, int(np.ceil(np.log2(windows / BAND_WINDOWS))))


def cells(h: np.ndarray, row: int, bits: int) -> np.ndarray:
    """The cells of window hashes in one row of the sketch."""
    return (h * (_R1, _R2)[row]) >> np.uint64(64 - bits)


def merged(parts: list[np.ndarray]) -> list[np.ndarray]:
    """Sketches of one band (the sorted cells of each) added up; for each part's cells, whether the sum is above one."""
    every = np.concatenate(parts)
    order = np.argsort(every, kind="stable")
    same = every[order][1:] == every[order][:-1]
    shared = np.zeros(len(every), bool)
    shared[order[1:][same]] = True
    shared[order[:-1][same]] = True
    return np.split(shared, np.cumsum([len(p) for p in parts])[:-1])


def covered(n: int, starts: np.ndarray, size: int = WINDOW) -> np.ndarray:
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, starts, 1)
    np.add.at(edge, np.minimum(starts + size, n), -1)
    return np.cumsum(edge[:n]) > 0


def _lines(words: bytes, n: int) -> list[bytes]:
    return words.split(b"\n") if n else []


def _entries(h1: np.ndarray, h2: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Positions of the first of each distinct window in (h1, h2) order, each window's entry, the entry's smallest id."""
    order = np.lexsort((h2, h1))
    new = np.ones(len(order), bool)
    new[1:] = (h1[order][1:] != h1[order][:-1]) | (h2[order][1:] != h2[order][:-1])
    entry = np.empty(len(order), np.int64)
    entry[order] = np.cumsum(new) - 1
    least = np.full(int(new.sum()), NULL_ID, np.int64)
    np.minimum.at(least, entry, ids)
    return order[new], entry, least


def remove_repeats(docs: DataFrame, block_bytes: int = BLOCK_BYTES, texts: bool = True) -> DataFrame:
    """docs(doc_id, text) -> doc_id, n_words, n_removed, kept (the words left, by single spaces), kept_sha256.

    Without texts, kept is null and not written for documents that lose nothing."""
    spark = docs.sparkSession
    ship(spark)
    with shuffles_removed(spark):
        return _remove_repeats(spark, docs, block_bytes, texts)


def _remove_repeats(spark: SparkSession, docs: DataFrame, block_bytes: int, texts: bool) -> DataFrame:
    block_path = scratch(spark, "blocks")
    to_blocks(docs, block_bytes).write.option("compression", "none").parquet(block_path)
    blocks = spark.read.parquet(block_path)
    total = blocks.agg(F.sum("size")).first()[0] or 0
    bits, lb = sketch_bits(total)
    low = np.uint64((1 << (bits - lb)) - 1)
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // TASK_BYTES))

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in one_by_one(batch):
                h = windows(unpacked(row["words"]))[4]
                for k in (0, 1):
                    c = distinct(cells(h, k, bits))
                    edges = np.searchsorted((c >> np.uint64(bits - lb)).astype(np.int64), np.arange((1 << lb) + 1))
                    some = np.flatnonzero(np.diff(edges))
                    blobs = [coded((c[edges[b] : edges[b + 1]] & low).astype(np.uint32)) for b in some]
                    yield pa.RecordBatch.from_pydict({"part": pa.array((k << lb) + some, pa.int64()), "block": pa.array([row["block"]] * len(some), pa.int64()), "blob": pa.array(blobs, pa.binary())})

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, rows in grouped(batches, "part"):
            marks = merged([decoded(r["blob"]) for r in rows])
            yield pa.RecordBatch.from_pydict({"block": pa.array([r["block"] for r in rows], pa.int64()), "part": pa.array([part] * len(rows), pa.int64()), "blob": pa.array([np.packbits(m).tobytes() for m in marks], pa.binary()), "n": pa.array([len(m) for m in marks], pa.int64())})

    sketches = blocks.select("block", "words").mapInArrow(sketch, "part long, block long, blob binary")
    mark_path = scratch(spark, "estimates")
    sketches.repartition(max(tasks, 2 << lb), "part").sortWithinPartitions("part", "block").mapInArrow(merge, "block long, part long, blob binary, n long").write.parquet(mark_path)
    marks = spark.read.schema("block long, part long, blob binary, n long").parquet(mark_path)
    release(spark)

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["kind", "part", "block", "n", "doc_id", "n_words", "sha", "blob", "ids", "nulls", "words", "kept"]
        kinds = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary(), pa.binary(), pa.binary(), pa.binary(), pa.string()]

        def out(rows: list[dict]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([r.get(c) for r in rows], k) for c, k in zip(names, kinds, strict=True)], names=names)

        for block, rows in grouped(batches, "block"):
            head, answers = rows[0], rows[1:]
            ids = np.frombuffer(head["ids"], np.int64)
            nulls = np.unpackbits(np.frombuffer(head["nulls"], np.uint8), count=len(ids)).astype(bool)
            words = unpacked(head["words"])
            lines = _lines(words, len(ids))
            begin, end, doc, _, h = windows(words)
            # Repeated in this block itself, by whole hashes.
            value, back = np.unique(h, return_inverse=True)
            least, most = np.full(len(value), NULL_ID, np.int64), np.full(len(value), -(2**63), np.int64)
            np.minimum.at(least, back, ids[doc])
            np.maximum.at(most, back, ids[doc])
            own = (least < most)[back] if len(h) else np.zeros(0, bool)
            # Repeated in another block, by the sketch: both of a window's cells are touched there.
            keep = np.ones(len(h), bool)
            for k in (0, 1):
                got = [np.unpackbits(np.frombuffer(r["blob"], np.uint8), count=r["n"]).astype(bool) for r in answers if r["part"] >> lb == k]
                mark = np.concatenate(got) if got else np.zeros(0, bool)
                c, back = np.unique(cells(h, k, bits), return_inverse=True)
                if len(mark) != len(c):
                    raise ValueError(f"block {block}: {len(c)} cells, {len(mark)} answers")
                keep &= mark[back] if len(h) else True
            keep |= own
            del value, back, own, h
            busy = np.zeros(len(ids), bool)
            busy[doc[keep]] = True
            free = np.flatnonzero(~busy)
            for s in range(0, len(free), 2000):
                yield out([{"kind": "r", "block": block, "doc_id": None if nulls[d] else int(ids[d]), "n_words": lines[d].count(b" ") + 1 if lines[d] else 0, "sha": hashlib.sha256(lines[d]).hexdigest(), "kept": lines[d].decode("utf-8", "surrogatepass") if texts else None} for d in free[s : s + 2000]])
            if not busy.any():
                continue
            held = np.flatnonzero(busy)
            mine = busy[doc]
            yield out([{"kind": "t", "block": block, "part": -1, "n": int(mine.sum()), "ids": ids[held].tobytes(), "nulls": np.packbits(nulls[held]).tobytes(), "words": packed(b"\n".join(lines[d] for d in held)), "blob": np.packbits(keep[mine]).tobytes()}])
            (a, b), i = digests(words, begin[keep], end[keep]), ids[doc[keep]]
            first, _, least = _entries(a, b, i)
            ea, eb = a[first], b[first]
            edges = np.searchsorted(ea >> np.uint64(64 - lb), np.arange((1 << lb) + 1, dtype=np.uint64))
            some = np.flatnonzero(np.diff(edges))
            yield out([{"kind": "c", "block": block, "part": int(p), "n": int(edges[p + 1] - edges[p]), "blob": squeezed(ea[edges[p] : edges[p + 1]], eb[edges[p] : edges[p + 1]], least[edges[p] : edges[p + 1]])} for p in some])

    none = F.lit(None)
    text_rows = blocks.select("block", F.lit(-1).cast("long").alias("part"), none.cast("binary").alias("blob"), none.cast("long").alias("n"), "ids", "nulls", "words")
    answer_rows = marks.select("block", "part", "blob", "n", none.cast("binary").alias("ids"), none.cast("binary").alias("nulls"), none.cast("binary").alias("words"))
    chosen = text_rows.unionByName(answer_rows).repartition(tasks, "block").sortWithinPartitions("block", "part").mapInArrow(choose, "kind string, part long, block long, n long, doc_id long, n_words long, sha string, blob binary, ids binary, nulls binary, words binary, kept string")
    path = scratch(spark, "windows")
    chosen.write.option("compression", "none").partitionBy("kind").parquet(path)
    drop_staged(spark, block_path)
    drop_staged(spark, mark_path)
    release(spark)
    stored = spark.read.schema("part long, block long, n long, doc_id long, n_words long, sha string, blob binary, ids binary, nulls binary, words binary, kept string, kind string").parquet(path)

    def group(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, rows in grouped(batches, "part"):
            n = np.array([r["n"] for r in rows])
            a, b, least = (np.concatenate(x) for x in zip(*(unsqueezed(r["blob"], r["n"]) for r in rows), strict=True))
            _, entry, lowest = _entries(a, b, least)
            smaller = lowest[entry] < least
            ends = np.cumsum(n)
            yield pa.RecordBatch.from_pydict({"block": pa.array([r["block"] for r in rows], pa.int64()), "part": pa.array([part] * len(rows), pa.int64()), "blob": pa.array([np.packbits(smaller[e - k : e]).tobytes() for e, k in zip(ends, n, strict=True)], pa.binary()), "n": pa.array(n, pa.int64())})

    sent = stored.where("kind = 'c'").select("part", "block", "n", "blob")
    smaller = sent.repartition(max(tasks, 1 << lb), "part").sortWithinPartitions("part", "block").mapInArrow(group, "block long, part long, blob binary, n long")
    smaller = staged(smaller, "answers")
    drop_staged(spark, f"{path}/kind=c")
    release(spark)

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, rows in grouped(batches, "block"):
            head, answers = rows[0], rows[1:]
            ids = np.frombuffer(head["ids"], np.int64)
            nulls = np.unpackbits(np.frombuffer(head["nulls"], np.uint8), count=len(ids)).astype(bool)
            words = unpacked(head["words"])
            lines = _lines(words, len(ids))
            begin, end, doc, first_word, _ = windows(words)
            keep = np.unpackbits(np.frombuffer(head["blob"], np.uint8), count=head["n"]).astype(bool)
            a, b = digests(words, begin[keep], end[keep])
            doc, first_word = doc[keep], first_word[keep]
            first, entry, least = _entries(a, b, ids[doc])
            answer = np.concatenate([np.unpackbits(np.frombuffer(r["blob"], np.uint8), count=r["n"]).astype(bool) for r in answers])
            if len(answer) != len(first):
                raise ValueError(f"block {block}: {len(first)} windows, {len(answer)} answers")
            gone = (ids[doc] > least[entry]) | answer[entry]
            doc, first_word = doc[gone], first_word[gone]
            at = np.searchsorted(doc, np.arange(len(ids) + 1))
            cols: dict[str, list] = {k: [] for k in ("doc_id", "n_words", "n_removed", "kept", "kept_sha256")}
            for d, line in enumerate(lines):
                raw = np.frombuffer(line + b" ", np.uint8)
                lengths = np.diff(np.flatnonzero(raw == 32), prepend=-1)
                cut = covered(len(lengths), first_word[at[d] : at[d + 1]])
                left = raw[~np.repeat(cut, lengths)].tobytes()[:-1]
                for k, v in zip(cols, (None if nulls[d] else int(ids[d]), len(lengths), int(cut.sum()), left.decode("utf-8", "surrogatepass") if texts else None, hashlib.sha256(left).hexdigest()), strict=True):
                    cols[k].append(v)
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string())
            yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(cols.values(), kinds, strict=True)], names=list(cols))

    text_rows = stored.where("kind = 't'").select("block", "part", "blob", "n", "ids", "nulls", "words")
    answer_rows = smaller.select("block", "part", "blob", "n", none.cast("binary").alias("ids"), none.cast("binary").alias("nulls"), none.cast("binary").alias("words"))
    cut = text_rows.unionByName(answer_rows).repartition(tasks, "block").sortWithinPartitions("block", "part").mapInArrow(finish, "doc_id long, n_words long, n_removed long, kept string, kept_sha256 string")
    whole = stored.where("kind = 'r'").select("doc_id", "n_words", F.lit(0).cast("long").alias("n_removed"), "kept", F.col("sha").alias("kept_sha256"))
    return whole.unionByName(cut)


def op5_substring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents"), texts=False).select("doc_id", "n_words", "n_removed", "kept_sha256")


OP5_SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
win AS (SELECT doc_id, i, array_to_string(w[i:i+12], ' ') AS s FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM d WHERE len(w) >= 13)),
f AS (SELECT s, min(doc_id) AS first FROM win GROUP BY s),
cut AS (SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS k FROM win JOIN f USING (s) WHERE doc_id > first),
word AS (SELECT doc_id, unnest(range(1, len(w) + 1)) AS k, unnest(w) AS x FROM d),
kept AS (SELECT doc_id, string_agg(x, ' ' ORDER BY k) AS t FROM word ANTI JOIN cut USING (doc_id, k) GROUP BY doc_id),
n AS (SELECT doc_id, count(*) AS c FROM cut GROUP BY doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(c, 0)::BIGINT AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id) LEFT JOIN n USING (doc_id)
"""
