"""Best-fit packing with large-item matching, planned on counts of lengths.

Documents become token ids plus a closing id 0; only longer ones than a sequence are cut, so that all pieces
but the first are full. A piece of more than a third of the capacity is large: at most two fit a sequence, so
large pieces are matched greedily, largest first, each with the largest partner that still fits. The rest go,
largest first, into the tightest remaining gap, and into new sequences when none fits.

All pieces of one length are alike to the packer, so it works on how many there are of each length: at most
``capacity`` numbers reach the driver, whatever the size of the corpus, and the plan (at most a few rows for each
length, each "q of this length in every one of m sequences") is exactly the plan of item-by-item best
fit. Each piece finds its place by its rank among the pieces of its length: a running number in its input
partition plus the counts of the partitions before. Nothing is sorted or gathered by length.

Defined results for odd input: null and empty texts are the single id 0; repeated rows are packed as
documents of their own; a null doc_id is kept; a text of any length, runs of a million equal characters among them,
is encoded whole; an empty table gives no rows; other columns are passed over.
Special-token strings in a text become that special id, as the tokenizer's own encode does.
"""

from __future__ import annotations

import base64
import os
import re
import zlib
from bisect import bisect_left, insort
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quarry.session import ship, staged, table

CAPACITY = 2048
END = 0
TOKENIZER = "byte_bpe_50k.json"
#: Rows put out at once.
ROWS = 4096
RANKS = "byte_bpe_50k.tiktoken"
SPECIAL = {"<|endoftext|>": 50256}
#: Texts that the tokenizers library itself takes: letters that the two libraries may class differently, and runs
#: of white space beyond what the other's regular expressions can step back over.
_OTHER = re.compile("[^\x00-\u024f]|\\s{10000}")
_TOKENIZERS: dict = {}


def tokenizer(name: str = TOKENIZER):
    """The public tokenizer, loaded once in a worker."""
    if name not in _TOKENIZERS:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        import public_tokenizers
        from tokenizers import Tokenizer

        _TOKENIZERS[name] = Tokenizer.from_file(public_tokenizers.path(name))
    return _TOKENIZERS[name]


def fast_tokenizer(name: str = RANKS):
    """The same vocabulary as ranks: the same ids at a quarter of the time."""
    if name not in _TOKENIZERS:
        import public_tokenizers
        import tiktoken

        with open(public_tokenizers.path(name), "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        _TOKENIZERS[name] = tiktoken.Encoding("byte_bpe_50k", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=SPECIAL)
    return _TOKENIZERS[name]


def token_ids(text: str | None) -> np.ndarray:
    """The text's ids, as the public tokenizer's own encode gives them."""
    text = text or ""
    if _OTHER.search(text):
        return np.array(tokenizer().encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4")
    return np.array(fast_tokenizer().encode(text, allowed_special="all"), "<u4")


def token_pieces(docs: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """docs(doc_id, text) -> pieces (doc_id, piece, start, length, ids_crc32, part, nth).

    part is the task's number and nth counts the pieces of the same length in it, so that
    (part, nth) orders the pieces of a length. A retried task counts the same way, and its output is committed once.
    """
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        seen: dict[int, int] = defaultdict(int)
        kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64())

        def given(cols: list[list]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names=["doc_id", "piece", "start", "length", "ids_crc32", "part", "nth"])

        for batch in batches:
            cols: list[list] = [[] for _ in kinds]
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                ids = np.append(token_ids(text), np.array(END, "<u4"))
                first = (len(ids) - 1) % capacity + 1
                starts = [0, *range(first, len(ids), capacity), len(ids)]
                for k, (a, b) in enumerate(zip(starts, starts[1:], strict=False)):
                    for col, v in zip(cols, (doc_id, k, a, b - a, zlib.crc32(ids[a:b].tobytes()), part, seen[b - a]), strict=True):
                        col.append(v)
                    seen[b - a] += 1
                if len(cols[0]) >= ROWS:
                    yield given(cols)
                    cols = [[] for _ in kinds]
            if cols[0]:
                yield given(cols)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, "doc_id long, piece int, start long, length long, ids_crc32 long, part long, nth long")


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> tuple[list[tuple[int, int, int, int, int]], int]:
    """Best fit with matched large items on counts of lengths.

    Returns rows (length, from_rank, per_sequence, first_sequence, offset): from that rank on, pieces of the length go
    per_sequence at a time, one after another from the offset, into sequences numbered from first_sequence;
    and the number of sequences. Rows of a length are in order of from_rank.
    """
    left = {n: c for n, c in counts.items() if c > 0}
    used: dict[int, int] = defaultdict(int)
    rows: list[tuple[int, int, int, int, int]] = []
    #: gap -> runs of sequences (first, how many) that have this gap left.
    gaps: dict[int, list[tuple[int, int]]] = defaultdict(list)
    order: list[int] = []
    bins = 0

    def put(length: int, per: int, first: int, many: int, gap: int) -> None:
        rows.append((length, used[length], per, first, capacity - gap))
        used[length] += per * many

    def free(gap: int, first: int, many: int) -> None:
        if gap > 0 and many > 0:
            if not gaps[gap]:
                insort(order, gap)
            gaps[gap].append((first, many))

    larges = sorted(n for n in left if 3 * n > capacity)
    while larges:
        n = larges[-1]
        if not left[n]:
            larges.pop()
            continue
        at = bisect_left(larges, capacity - n + 1) - 1
        while at >= 0 and not left[larges[at]]:
            larges.pop(at)
            at -= 1
        m = larges[at] if at >= 0 else None
        if m is None:
            many = left[n]
            put(n, 1, bins, many, capacity)
            free(capacity - n, bins, many)
            left[n] = 0
        elif m == n:
            many = left[n] // 2
            if many:
                put(n, 2, bins, many, capacity)
                free(capacity - 2 * n, bins, many)
                bins += many
            left[n] -= 2 * many
            many = left[n]
            if many:  # one is over: its partner is the next smaller
                at -= 1
                while at >= 0 and not left[larges[at]]:
                    at -= 1
                put(n, 1, bins, 1, capacity)
                if at >= 0:
                    put(larges[at], 1, bins, 1, capacity - n)
                    left[larges[at]] -= 1
                    free(capacity - n - larges[at], bins, 1)
                else:
                    free(capacity - n, bins, 1)
                left[n] = 0
        else:
            many = min(left[n], left[m])
            put(n, 1, bins, many, capacity)
            put(m, 1, bins, many, capacity - n)
            free(capacity - n - m, bins, many)
            left[n] -= many
            left[m] -= many
        bins += many
    for n in sorted((n for n in left if 3 * n <= capacity), reverse=True):
        while left[n]:
            at = bisect_left(order, n)
            if at == len(order):
                per = capacity // n
                many, rest = divmod(left[n], per)
                if many:
                    put(n, per, bins, many, capacity)
                    free(capacity - per * n, bins, many)
                    bins += many
                if rest:
                    put(n, rest, bins, 1, capacity)
                    free(capacity - rest * n, bins, 1)
                    bins += 1
                left[n] = 0
                break
            gap = order[at]
            first, many = gaps[gap].pop()
            if not gaps[gap]:
                order.pop(at)
            per = gap // n
            full = min(many, left[n] // per)
            if full:
                put(n, per, first, full, gap)
                free(gap - per * n, first, full)
                left[n] -= per * full
            if full < many:
                rest = left[n]
                if rest:
                    put(n, rest, first + full, 1, gap)
                    free(gap - rest * n, first + full, 1)
                    left[n] = 0
                    full += 1
                free(gap, first + full, many - full)
    return rows, bins


def pack(docs: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """docs(doc_id, text) -> doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    spark = docs.sparkSession
    pieces = staged(token_pieces(docs, capacity), "pieces")
    counts = staged(pieces.groupBy("length", "part").agg(F.count("*").alias("n")), "piece-counts")
    rows, _ = plan({r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}, capacity)
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("length", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    by_length: dict[int, tuple[np.ndarray, ...]] = {}
    grouped: dict[int, list] = defaultdict(list)
    for r in rows:
        grouped[r[0]].append(r[1:])
    for n, some in grouped.items():
        by_length[n] = tuple(np.array(c, np.int64) for c in zip(*sorted(some), strict=True))
    held = spark.sparkContext.broadcast(by_length)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = batch.column("length").to_numpy(), batch.column("rank").to_numpy()
            sequence, offset = np.empty(len(length), np.int64), np.empty(len(length), np.int64)
            order = np.argsort(length, kind="stable")
            edges = np.flatnonzero(np.diff(length[order], prepend=-1))
            for a, b in zip(edges, np.append(edges[1:], len(order)), strict=True):
                some = order[a:b]
                n = int(length[some[0]])
                begin, per, first, at = held.value[n]
                k = np.searchsorted(begin, rank[some], "right") - 1
                i = rank[some] - begin[k]
                sequence[some] = first[k] + i // per[k]
                offset[some] = at[k] + (i % per[k]) * n
            keep = ["doc_id", "piece", "start", "length", "ids_crc32"]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), pa.array(sequence), pa.array(offset)], names=[*keep, "sequence_id", "offset"])

    # Counts are as many as lengths and tasks: beside the pieces too many to broadcast, so a hashed join.
    ranked = pieces.join(offsets.hint("shuffle_hash"), ["length", "part"]).select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("before") + F.col("nth")).alias("rank"))
    return ranked.mapInArrow(place, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))
