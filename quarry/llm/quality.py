"""Quality by a byte-level convolutional network in numpy.

A whole text is a sequence of UTF-8 bytes. Chunks of 16 bytes start every 4 bytes, so they overlap and
cover the document; each byte is embedded in 8 numbers and each chunk goes through 32 learned filters
(a matrix product) and a rectifier. The chunk at every place also has 22 fixed inputs: for each lag from
2 to 23 the share of its bytes that equal those a lag before, which lets filters see repetition. Activations are pooled
by maximum over all chunks of the document; a learned layer combines them into one probability.

Training is by Adam on a bounded, balanced sample of labelled rows outside the held-out fold
(MAX_PER_CLASS documents of each class, whole texts). The gradient of the maximum goes to one chunk a
filter, so a step costs little beyond the forward pass. Long documents are run in blocks of chunks;
memory does not grow with a document's length.

Defined results for odd input: null and empty texts are one chunk of padding and get a score;
repeated rows score alike; without labels of both classes every score is the share of label 1 (0.5 if
there are none); a null doc_id is scored; other columns are passed over.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from quarry.llm.folds import held_out, label_rows, texts_of
from quarry.session import ship, table

MAX_PER_CLASS = 1000
#: Documents shown in training, all epochs together; at least 5 epochs.
VISITS = 14_000
THRESHOLD = 0.3
WIDTH, STRIDE, EMBED, FILTERS = 16, 4, 8, 32
LAGS = tuple(range(2, 24))
#: Chunks handled at once.
BLOCK = 16384


def chunk_bytes(text: str | None) -> np.ndarray:
    """The text's bytes, padded by zeros before (for the lags) and behind (for whole chunks)."""
    raw = np.frombuffer((text or "").encode("utf-8", "surrogatepass"), np.uint8)
    n = max(1, -(-max(0, len(raw) - WIDTH) // STRIDE) + 1)
    out = np.zeros(LAGS[-1] + (n - 1) * STRIDE + WIDTH, np.uint8)
    out[LAGS[-1] : LAGS[-1] + len(raw)] = raw
    return out


def inputs(padded: np.ndarray, embed: np.ndarray, first: int, last: int) -> np.ndarray:
    """Rows of chunks first..last-1: embedded bytes, then the share of bytes equal at each lag."""
    head, n = LAGS[-1], last - first
    a, b = head + first * STRIDE, head + (last - 1) * STRIDE + WIDTH
    part = padded[a:b]
    x = np.empty((n, WIDTH * EMBED + len(LAGS)), np.float32)
    e = embed[part]
    x[:, : WIDTH * EMBED] = np.lib.stride_tricks.as_strided(e, (n, WIDTH * EMBED), (STRIDE * EMBED * 4, 4))
    for j, lag in enumerate(LAGS):
        same = (part == padded[a - lag : b - lag]) & (part != 0)
        by = (same.view(np.uint32) * np.uint32(0x01010101) >> np.uint32(24)).astype(np.uint8)  # ones among four
        x[:, WIDTH * EMBED + j] = (by[:n] + by[1 : n + 1] + by[2 : n + 2] + by[3 : n + 3]) * np.float32(1 / WIDTH)
    return x


@dataclass
class Net:
    embed: np.ndarray
    filters: np.ndarray
    shift: np.ndarray
    out: np.ndarray
    bias: float
    flat: float | None = None

    def pooled(self, text: str | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Maximum of each filter over all chunks, the chunk that has it, the padded bytes."""
        padded = chunk_bytes(text)
        n = (len(padded) - LAGS[-1] - WIDTH) // STRIDE + 1
        best, at = np.full(self.filters.shape[1], -np.inf, np.float32), np.zeros(self.filters.shape[1], np.int64)
        for first in range(0, n, BLOCK):
            last = min(n, first + BLOCK)
            z = inputs(padded, self.embed, first, last) @ self.filters
            k = z.argmax(0)
            v = z[k, np.arange(z.shape[1])]
            better = v > best
            best[better], at[better] = v[better], first + k[better]
        return best + self.shift, at, padded

    def score(self, text: str | None) -> float:
        if self.flat is not None:
            return self.flat
        h = np.maximum(self.pooled(text)[0], 0)
        return float(1 / (1 + np.exp(-np.clip(float(h @ self.out) + self.bias, -30, 30))))


def fit(texts: list[str], labels: list[int], seed: int = 7, visits: int = VISITS, batch: int = 32, rate: float = 4e-3) -> Net:
    """Train on whole texts; the same input in the same order gives the same network."""
    rng = np.random.default_rng(seed)
    y = np.array(labels, np.float64)
    wide = WIDTH * EMBED + len(LAGS)
    net = Net(rng.normal(0, 0.5, (256, EMBED)).astype(np.float32), rng.normal(0, 1 / np.sqrt(WIDTH * EMBED), (wide, FILTERS)).astype(np.float32), np.zeros(FILTERS, np.float32), rng.normal(0, 0.1, FILTERS).astype(np.float32), 0.0)
    if len(y) == 0 or y.min() == y.max():
        net.flat = float(y.mean()) if len(y) else 0.5
        return net
    weight = np.where(y == 1, 0.5 / y.mean(), 0.5 / (1 - y.mean()))
    names = ("embed", "filters", "shift", "out")
    m, v = {k: np.zeros_like(getattr(net, k)) for k in (*names,)}, {k: np.zeros_like(getattr(net, k)) for k in names}
    mb = vb = 0.0
    steps = 0
    epochs = max(5, visits // len(y))
    total = epochs * -(-len(y) // batch)
    for _ in range(epochs):
        order = rng.permutation(len(y))
        for s in range(0, len(order), batch):
            some = order[s : s + batch]
            g = {k: np.zeros_like(getattr(net, k)) for k in names}
            gb = 0.0
            for i in some:
                best, at, padded = net.pooled(texts[i])
                h = np.maximum(best, 0)
                d = weight[i] * (1 / (1 + np.exp(-np.clip(float(h @ net.out) + net.bias, -30, 30))) - y[i]) / len(some)
                gb += d
                g["out"] += np.float32(d) * h
                dz = np.where(best > 0, np.float32(d) * net.out, 0).astype(np.float32)
                g["shift"] += dz
                rows = at * STRIDE + LAGS[-1]
                spans = padded[rows[:, None] + np.arange(WIDTH)]
                x = np.empty((FILTERS, wide), np.float32)
                x[:, : WIDTH * EMBED] = net.embed[spans].reshape(FILTERS, -1)
                for j, lag in enumerate(LAGS):
                    x[:, WIDTH * EMBED + j] = ((spans == padded[rows[:, None] + np.arange(WIDTH) - lag]) & (spans != 0)).mean(1)
                g["filters"] += x.T * dz
                back = (net.filters[: WIDTH * EMBED].T * dz[:, None]).reshape(-1, EMBED)
                np.add.at(g["embed"], spans.reshape(-1), back)
            steps += 1
            now = rate * min(1.0, 2.0 * (1 - steps / (total + 1)))
            for k in names:
                p = g[k] + np.float32(1e-4) * getattr(net, k)
                m[k] = 0.9 * m[k] + 0.1 * p
                v[k] = 0.99 * v[k] + 0.01 * p * p
                setattr(net, k, (getattr(net, k) - now * (m[k] / (1 - 0.9**steps)) / (np.sqrt(v[k] / (1 - 0.99**steps)) + 1e-8)).astype(np.float32))
            mb, vb = 0.9 * mb + 0.1 * gb, 0.99 * vb + 0.01 * gb * gb
            net.bias -= float(now * (mb / (1 - 0.9**steps)) / (np.sqrt(vb / (1 - 0.99**steps)) + 1e-8))
    return net


def train(docs: DataFrame, labels: DataFrame, max_per_class: int = MAX_PER_CLASS) -> Net:
    known = label_rows(labels, "quality")
    rows = [r for value in (0, 1) for r in texts_of(docs, known.where(F.col("label") == value), max_per_class)]
    rows.sort()
    return fit([t for _, t, _ in rows], [y for _, _, y in rows])


def score(docs: DataFrame, net: Net, threshold: float = THRESHOLD) -> DataFrame:
    """docs plus score and predicted in one narrow pass; other columns pass through (a clashing one is replaced)."""
    spark = docs.sparkSession
    ship(spark)
    docs = docs.drop("score", "predicted")
    held = spark.sparkContext.broadcast(net)
    fields = [f.name for f in docs.schema.fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = held.value.score
        for batch in batches:
            scores = pa.array([of(x) for x in batch.column("text").to_pylist()], pa.float64())
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in fields), scores], names=[*fields, "score"])

    return docs.mapInArrow(run, StructType([*docs.schema.fields, StructField("score", DoubleType())])).withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    net = train(docs, table(spark, sf_dir, "labels"))
    return score(docs.select("doc_id", "text"), net).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")
