"""Benchmark decontamination by one Aho-Corasick automaton over normalised benchmark items.

Words are runs of ASCII letters, digits and non-ASCII characters, A-Z lower-cased. A window is 13 consecutive words of
an item; an item of fewer words, but not none, is one window. The automaton runs over numbers of the benchmark's
words (any other word of a document is 0), so that a state stands for a word and not for a letter.

Its patterns are the items' runs of 7 words at every 7th place: each window of 13 holds one of them, and their states
are as many as the benchmark has words, not 13 times as many. Where one is found, the seven windows around it are looked up
in a table of the items' windows (by hash, then word by word), in which equal windows are one entry with all their items: the
work follows the document's words, not the number of items that share a run. Short items are patterns as a whole.
Each whole text is scanned once.

The automaton covers a block of items of at most ``block_words`` words (5 million: about 1 GB in each Python worker, that is
for each core of an executor that is given no smaller bound). Only where
the benchmark is larger, the documents are scanned by one automaton per block, a staged table between them; results do
not differ.

Defined results for odd input: null and empty texts have no words, no hit and are never contaminated;
null and empty items have no windows; repeated items count once per distinct item_id; repeated
documents give a row each; a null doc_id is kept as it is; an empty benchmark marks nothing; other
columns are passed over.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.session import ship, staged, table

WINDOW = 13
#: Words of items that one automaton holds; about 200 bytes of memory each.
BLOCK_WORDS = 5_000_000

_WORD_TABLE = bytes((c | 0x20) if 0x41 <= c <= 0x5A else c if c >= 0x80 or 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A else 0x20 for c in range(256))
_AUTOMATA: dict[str, tuple] = {}


def words_of(text: str | None) -> list[bytes]:
    """Normalised words as UTF-8; only ASCII bytes are ever separators, so code points stay whole."""
    return (text or "").encode("utf-8", "surrogatepass").translate(_WORD_TABLE).split()


def _rolling(numbers: np.ndarray, window: int, seed: int) -> np.ndarray:
    """64-bit hashes of all runs of window numbers."""
    mixed = (numbers.astype(np.uint64) + np.uint64(seed)) * np.uint64(0x9E3779B97F4A7C15)
    mixed ^= mixed >> np.uint64(29)
    out = np.zeros(max(0, len(numbers) - window + 1), np.uint64)
    for k in range(window):
        out = out * np.uint64(0xBF58476D1CE4E5B9) + mixed[k : k + len(out)]
    return out


class Matcher:
    """The automaton over a block of distinct items: (words joined by spaces, ids of the items that say them).

    Beside it stands a table of the items' windows: hashes in order, for each the place of one such window, and the items
    that have it. Equal windows are one entry, however many items share them."""

    def __init__(self, items: list[tuple[bytes, list[str]]], window: int = WINDOW):
        self.window, self.step, self.owners = window, (window + 1) // 2, [ids for _, ids in items]
        self.numbers: dict[bytes, int] = {}
        flat: list[int] = []
        begin = [0]
        for text, _ in items:
            flat += [self.numbers.setdefault(w, len(self.numbers) + 1) for w in text.split()]
            begin.append(len(flat))
        self.flat = np.array(flat, np.int64)
        patterns: dict[tuple[int, ...], list[int]] = {}  # short items that are the pattern; a long item's grams have none
        long = []
        for k, (a, b) in enumerate(zip(begin, begin[1:], strict=False)):
            if b - a >= window:
                long.append(k)
                for p in range(a, b - self.step + 1, self.step):
                    patterns.setdefault(tuple(flat[p : p + self.step]), [])
            else:
                patterns.setdefault(tuple(flat[a:b]), []).append(k)
        self.found = ahocorasick.Automaton(ahocorasick.STORE_ANY, ahocorasick.KEY_SEQUENCE)
        for pattern, short in patterns.items():
            self.found.add_word(pattern, (len(pattern), tuple(short)))
        if patterns:
            self.found.make_automaton()
        self.empty = not patterns
        sizes = np.array([begin[k + 1] - begin[k] - window + 1 for k in long], np.int64)
        starts = np.repeat(np.array([begin[k] for k in long], np.int64) - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())
        item = np.repeat(np.array(long, np.int64), sizes)
        for self.seed in range(64):
            h = _rolling(self.flat, window, self.seed)[starts]
            self.hashes, first, entry = np.unique(h, return_index=True, return_inverse=True)
            self.place = starts[first]
            if self._equal(self.flat, starts, self.place[entry]).all():  # else two different windows have one hash
                break
        else:
            raise ValueError("windows cannot be told apart")
        pairs = np.unique(entry * len(items) + item) if len(entry) else np.zeros(0, np.int64)
        self.items = pairs % max(1, len(items))
        self.items_from = np.searchsorted(pairs, np.arange(len(self.hashes) + 1) * len(items))

    def _equal(self, doc: np.ndarray, at: np.ndarray, place: np.ndarray) -> np.ndarray:
        """Where the window of doc at ``at`` is that of the items at ``place``."""
        same = np.ones(len(at), bool)
        for k in range(self.window):
            same &= doc[at + k] == self.flat[place + k]
        return same

    def hits(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        """Merged ranges of hit words and the items whose windows occur.

        A found run of words points at the windows around it, which are looked up in the table: what a run costs does not depend on how many
        items have it."""
        if self.empty or not words:
            return [], set()
        of = self.numbers.get
        numbers = [of(w, 0) for w in words]
        runs, spans, found = [], [], set()
        for end, (n, short) in self.found.iter(tuple(numbers)):
            if n == self.step:
                runs.append(end - n + 1)
            if short:
                spans.append((end - n + 1, end + 1))
                found.update(short)
        if runs and len(numbers) >= self.window:
            doc = np.array(numbers, np.int64)
            at = np.unique(np.array(runs, np.int64)[:, None] - np.arange(self.window - self.step + 1))
            at = at[(at >= 0) & (at <= len(doc) - self.window)]
            h = _rolling(doc, self.window, self.seed)[at]
            entry = np.minimum(np.searchsorted(self.hashes, h), len(self.hashes) - 1) if len(self.hashes) else np.zeros(0, np.int64)
            use = self.hashes[entry] == h if len(self.hashes) else np.zeros(len(at), bool)
            at, entry = at[use], entry[use]
            use = self._equal(doc, at, self.place[entry])
            spans += [(i, i + self.window) for i in at[use].tolist()]
            for e in np.unique(entry[use]).tolist():
                found.update(self.items[self.items_from[e] : self.items_from[e + 1]].tolist())
        return merged(spans), {i for k in found for i in self.owners[k]}


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def _matcher(items: list[tuple[bytes, list[str]]], window: int, key: str) -> Matcher:
    """Built once per worker."""
    if key not in _AUTOMATA:
        _AUTOMATA.clear()
        _AUTOMATA[key] = Matcher(items, window)
    return _AUTOMATA[key]


def _blocks(benchmark: DataFrame, block_words: int) -> Iterator[list[tuple[bytes, list[str]]]]:
    """Distinct item texts with their ids, in blocks of bounded size; items stream to the driver one partition at a time, and
    a block is given away before the next one is gathered."""
    owners: dict[bytes, set[str]] = {}
    size = 0
    for item_id, text in benchmark.select(F.col("item_id").cast("string"), "text").toLocalIterator():
        words = words_of(text)
        said = b" ".join(words)
        if words and said not in owners:
            owners[said] = set()
            size += len(words)
        if words and item_id is not None:
            owners[said].add(item_id)
        if size >= block_words:
            yield [(w, sorted(s)) for w, s in sorted(owners.items())]
            owners, size = {}, 0
    yield [(w, sorted(s)) for w, s in sorted(owners.items())]


def original_offsets(text: str, ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Code point ranges in the original text of ranges of words."""
    raw = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    word = np.frombuffer(_WORD_TABLE, np.uint8)[raw] != 32
    edge = np.diff(np.concatenate(([0], word.astype(np.int8), [0])))
    begins, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    points = np.concatenate(([0], np.cumsum((raw & 0xC0) != 0x80)))  # code points before each byte
    return [(int(points[begins[a]]), int(points[ends[b - 1]])) for a, b in ranges]


def find_contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_words: int = BLOCK_WORDS, carry: tuple[str, ...] = ()) -> DataFrame:
    """docs(doc_id, text) -> doc_id, text, n_words, word_ranges, spans (code points), items (sorted strings).

    Columns named in carry come along as one struct, "carried", whatever their names. One narrow pass;
    nothing is shuffled.
    """
    spark = docs.sparkSession
    ship(spark)
    out = "doc_id long, text string, n_words long, word_ranges array<struct<a:int,b:int>>, spans array<struct<a:int,b:int>>, items array<string>"
    df = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.lit(None).cast("array<struct<a:int,b:int>>").alias("word_ranges"), F.lit(None).cast("array<string>").alias("items"), F.struct(F.lit(0).alias("_"), *carry).alias("carried"))
    out += f", carried {df.schema['carried'].dataType.simpleString()}"
    for n, items in enumerate(_blocks(benchmark, block_words)):
        if n:
            df = staged(df, "decontaminate")
        held = spark.sparkContext.broadcast(items)
        key = hashlib.sha256(repr((window, items)).encode()).hexdigest()

        def scan(batches: Iterator[pa.RecordBatch], held=held, key=key) -> Iterator[pa.RecordBatch]:
            matcher = _matcher(held.value, window, key)
            kind = pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32())]))
            for batch in batches:
                texts, counts, ranges, spans, found = batch.column("text"), [], [], [], []
                for text, before, known in zip(texts.to_pylist(), batch.column("word_ranges").to_pylist(), batch.column("items").to_pylist(), strict=True):
                    words = words_of(text)
                    here, ids = matcher.hits(words)
                    here = merged(here + [(r["a"], r["b"]) for r in before or ()])
                    counts.append(len(words))
                    ranges.append([{"a": a, "b": b} for a, b in here])
                    spans.append([{"a": a, "b": b} for a, b in original_offsets(text, here)] if here else [])
                    found.append(sorted(ids | set(known or ())))
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), texts, pa.array(counts, pa.int64()), pa.array(ranges, kind), pa.array(spans, kind), pa.array(found, pa.list_(pa.string())), batch.column("carried")], names=["doc_id", "text", "n_words", "word_ranges", "spans", "items", "carried"])

        df = df.select("doc_id", "text", "word_ranges", "items", "carried").mapInArrow(scan, out)
    return df


def _n_hit() -> Column:
    return F.aggregate("word_ranges", F.lit(0).cast("long"), lambda n, r: n + (r["b"] - r["a"]).cast("long"))


def _contaminated() -> Column:
    return (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """docs without the rows that hold a passage of the benchmark, all columns as they are.

    A row goes if a whole window of an item occurs in it, however long the rest is, or if hit words (short items among
    them) are a twentieth of its words. Short items that occur in a long text are no reason: they are common phrases."""
    found = find_contamination(docs, benchmark, window, carry=tuple(docs.columns)).withColumn("n_hit", _n_hit())
    passage = F.exists("word_ranges", lambda r: r["b"] - r["a"] >= window)
    return found.where(~passage & ~_contaminated()).select(*(F.col("carried").getField(c).alias(c) for c in docs.columns))


def contamination_report(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    n_hit = _n_hit()
    return (
        find_contamination(docs, benchmark, window)
        .select("doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"), F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"))
        .withColumn("contaminated", _contaminated())
    )


def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


OP10_SQL = r"""
WITH low AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
items AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
pat AS (
  SELECT DISTINCT item_id, array_to_string(w[i:i+12], ' ') AS p, 13 AS n FROM (SELECT item_id, w, unnest(range(1, len(w) - 11)) AS i FROM items WHERE len(w) >= 13)
  UNION ALL SELECT DISTINCT item_id, array_to_string(w, ' '), len(w) FROM items WHERE len(w) BETWEEN 1 AND 12),
sizes AS (SELECT DISTINCT n FROM pat),
win AS (SELECT doc_id, n, i, array_to_string(w[i:i+n-1], ' ') AS p FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM low, sizes WHERE len(w) >= n)),
hits AS (SELECT DISTINCT doc_id, i, win.n, item_id FROM win JOIN pat ON pat.p = win.p AND pat.n = win.n),
cover AS (SELECT doc_id, count(DISTINCT k) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS k FROM hits) GROUP BY doc_id),
found AS (SELECT doc_id, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS ids FROM hits GROUP BY doc_id)
SELECT low.doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM low LEFT JOIN cover USING (doc_id) LEFT JOIN found USING (doc_id)
"""
