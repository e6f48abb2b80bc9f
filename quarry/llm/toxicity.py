"""Toxicity by non-negative positive-unlabelled learning with numpy classifiers.

Confirmed toxic documents are the positives; the unlabelled set is a sample of labelled rows outside the
held-out fold, toxic ones among them, whose labels are not looked at. With class prior pi, the risk
``pi*E_P[l(g)] + max(0, E_U[l(-g)] - pi*E_P[l(-g)])`` is minimised, and where the bracket turns
negative the gradient climbs out of it instead. Several linear classifiers over the words of a whole
text, trained from different random orders, are averaged.

Features are presences of words and of word beginnings (4 to 6 bytes) from a vocabulary chosen on the training sample by how much oftener
they stand in positives than in unlabelled text; a text of any length is read whole. Positives are a part of
the unlabelled set, as large as the prior says, so a real feature of theirs stands there too: one that is much rarer
there than its share of positives allows is chance and left out. The prior is estimated from the labels of the training
folds (their toxic share).

Bounds (documented parameters): MAX_POSITIVE and MAX_UNLABELLED labelled documents reach the driver.

Defined results for odd input: null and empty texts get the score of a text without known words;
repeated rows are scored alike; without toxic or without any training rows every score is the prior;
a null doc_id is scored and is not in the held-out fold unless crc32('') says so; other columns are passed over.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from quarry.llm.decontaminate import words_of
from quarry.llm.folds import held_out, label_rows, order_key, texts_of
from quarry.session import ship, table

MAX_POSITIVE = 3000
MAX_UNLABELLED = 6000
VOCABULARY = 4000
THRESHOLD = 0.5
SEEDS = (1, 2, 3)


#: Words whose features are remembered while a worker scores; beyond it the memory is emptied.
REMEMBERED = 300_000


def word_features(word: bytes) -> list[bytes]:
    return [word, *(b"%d:" % n + word[:n] for n in (4, 5, 6) if len(word) > n)]


def number(feature: bytes) -> int:
    """A feature as a 64-bit number; training and models hold only these."""
    return xxhash.xxh3_64_intdigest(feature)


def features(text: str | None) -> np.ndarray:
    return np.unique(np.array([number(f) for w in set(words_of(text)) for f in word_features(w)], np.uint64))


@dataclass
class Model:
    weights: dict[int, float]
    bias: float

    def scorer(self):
        """A function from text to probability that remembers the features of words it has seen."""
        seen: dict[bytes, tuple[int, ...]] = {}
        weights, bias = self.weights, self.bias

        def score(text: str | None) -> float:
            if len(seen) > REMEMBERED:
                seen.clear()
            found: set[int] = set()
            for w in set(words_of(text)):
                known = seen.get(w)
                if known is None:
                    known = seen[w] = tuple(f for f in map(number, word_features(w)) if f in weights)
                if known:
                    found.update(known)
            z = bias + sum(weights[f] for f in sorted(found))
            return float(1 / (1 + np.exp(-min(max(z, -30.0), 30.0))))

        return score

    def score(self, text: str | None) -> float:
        return self.scorer()(text)


def vocabulary(positive: list[np.ndarray], unlabelled: list[np.ndarray], prior: float, size: int = VOCABULARY) -> np.ndarray:
    """Features whose share among positives exceeds chance by a one-sided z statistic, and that unlabelled text
    holds at least a quarter as often as positives within it would; sorted."""
    n_p, n_u = max(1, len(positive)), max(1, len(unlabelled))
    f, a = np.unique(np.concatenate(positive), return_counts=True)
    f, a = f[a >= 3], a[a >= 3]
    g, c = np.unique(np.concatenate(unlabelled), return_counts=True)
    at = np.minimum(np.searchsorted(g, f), max(0, len(g) - 1))
    u = np.where(g[at] == f, c[at], 0) if len(g) else np.zeros(len(f))
    # Under "no relation", positives hold the feature as often as unlabelled text does.
    rate = (a + u + 1) / (n_p + n_u + 2)
    z = (a / n_p - u / n_u) / np.sqrt(rate * (1 - rate) * (1 / n_p + 1 / n_u))
    good = (z > 3.0) & (u / n_u >= 0.25 * prior * a / n_p)
    f, z = f[good], z[good]
    return np.sort(f[np.lexsort((f, -z))[:size]])


def _sparse(docs: list[np.ndarray], words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows and columns of the presences of chosen features."""
    if not len(words):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    flat = np.concatenate(docs)
    rows = np.repeat(np.arange(len(docs)), [len(d) for d in docs])
    at = np.minimum(np.searchsorted(words, flat), len(words) - 1)
    hit = words[at] == flat
    return rows[hit], at[hit]


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def risk(z_p: np.ndarray, z_u: np.ndarray, prior: float) -> tuple[float, float]:
    """The two parts of the risk under the logistic loss l(z) = log(1 + exp(-z)): positives as positive, and the bracket
    (negatives, as unlabelled less the positives' share), which may be negative before it is cut at zero."""
    n_p, n_u = max(1, len(z_p)), max(1, len(z_u))
    return prior * float(np.logaddexp(0, -z_p).sum()) / n_p, float(np.logaddexp(0, z_u).sum()) / n_u - prior * float(np.logaddexp(0, z_p).sum()) / n_p


def slopes(z_p: np.ndarray, z_u: np.ndarray, prior: float) -> tuple[np.ndarray, np.ndarray]:
    """What a step follows, by each score: the slope of the whole risk, or where the bracket is negative
    the bracket's own, reversed."""
    n_p, n_u = max(1, len(z_p)), max(1, len(z_u))
    d_u, d_p = _sigmoid(z_u) / n_u, -prior * _sigmoid(z_p) / n_p
    if risk(z_p, z_u, prior)[1] >= 0:
        return d_p - prior * (1 - _sigmoid(z_p)) / n_p, d_u
    return -d_p, -d_u


def nn_pu(positive: list[np.ndarray], unlabelled: list[np.ndarray], words: np.ndarray, prior: float, seed: int, epochs: int = 120, rate: float = 0.1, decay: float = 2e-5) -> tuple[np.ndarray, float]:
    """One linear classifier by full sweeps over random thirds of both sets (Adam)."""
    rng = np.random.default_rng(seed)
    (pr, pc), (ur, uc) = _sparse(positive, words), _sparse(unlabelled, words)
    w, b = np.zeros(len(words)), -1.0
    m, v, t = np.zeros(len(words) + 1), np.zeros(len(words) + 1), 0
    for _ in range(epochs):
        fold_p, fold_u = rng.integers(0, 3, len(positive)), rng.integers(0, 3, len(unlabelled))
        for k in range(3):
            use_p, use_u = fold_p == k, fold_u == k
            d_p, d_u = np.zeros(len(positive)), np.zeros(len(unlabelled))
            d_p[use_p], d_u[use_u] = slopes((np.bincount(pr, w[pc], len(positive)) + b)[use_p], (np.bincount(ur, w[uc], len(unlabelled)) + b)[use_u], prior)
            g = np.bincount(pc, d_p[pr], len(words)) + np.bincount(uc, d_u[ur], len(words)) + decay * w
            g = np.append(g, d_p.sum() + d_u.sum())
            t += 1
            m = 0.9 * m + 0.1 * g
            v = 0.999 * v + 0.001 * g * g
            step = rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
            w, b = w - step[:-1], b - step[-1]
    return w, float(b)


def fit(positive: list[str], unlabelled: list[str], prior: float, seeds: tuple[int, ...] = SEEDS) -> Model:
    prior = float(min(max(prior, 1e-3), 0.9))
    if not positive or not unlabelled:
        return Model({}, float(np.log(prior / (1 - prior))))
    p, u = [features(x) for x in positive], [features(x) for x in unlabelled]
    words = vocabulary(p, u, prior)
    fits = [nn_pu(p, u, words, prior, s) for s in seeds]
    w = np.mean([f[0] for f in fits], axis=0) if len(words) else np.zeros(0)
    return Model({int(x): float(y) for x, y in zip(words, w, strict=True)}, float(np.mean([f[1] for f in fits])))


def train(docs: DataFrame, labels: DataFrame, max_positive: int = MAX_POSITIVE, max_unlabelled: int = MAX_UNLABELLED) -> Model:
    known = label_rows(labels, "toxic")
    counts = known.agg(F.avg("label").alias("prior"), F.count("*").alias("n")).first()
    if not counts["n"]:
        return fit([], [], 0.05)
    positive = texts_of(docs, known.where("label = 1"), max_positive)
    unlabelled = texts_of(docs, known.select("doc_id", F.lit(0).alias("label")), max_unlabelled)
    return fit([t for _, t, _ in positive], [t for _, t, _ in unlabelled], counts["prior"])


def score(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """docs plus score and predicted; one narrow pass over whole texts, other columns pass through (a clashing one is replaced)."""
    spark = docs.sparkSession
    ship(spark)
    docs = docs.drop("score", "predicted")
    held = spark.sparkContext.broadcast(model)
    fields = [f.name for f in docs.schema.fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = held.value.scorer()
        for batch in batches:
            scores = pa.array([of(x) for x in batch.column("text").to_pylist()], pa.float64())
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in fields), scores], names=[*fields, "score"])

    schema = StructType([*docs.schema.fields, StructField("score", DoubleType())])
    return docs.mapInArrow(run, schema).withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = train(docs, table(spark, sf_dir, "labels"))
    return score(docs.select("doc_id", "text"), model).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")
