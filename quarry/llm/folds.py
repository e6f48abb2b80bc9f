"""Held-out folds and bounded, reproducible samples of labelled rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FOLDS = 5


def held_out(doc_id: Column) -> Column:
    """True where crc32 of the id as text leaves no remainder by 5 (a null id counts as the text '')."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % FOLDS == 0


def order_key(doc_id: Column) -> Column:
    """A fixed pseudo-random order of documents; a sample is the first n in it."""
    return F.xxhash64(doc_id, F.lit("sample"))


def label_rows(labels: DataFrame, column: str) -> DataFrame:
    """doc_id and label (0 or 1, the larger where they differ) of the labelled rows outside the held-out fold."""
    return (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(column).cast("int").alias("label"))
        .where(F.col("doc_id").isNotNull() & F.col("label").isin(0, 1) & ~held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.max("label").alias("label"))
    )


#: Bytes of texts that one sample may bring to the driver; the first rows in the fixed order that fit.
MAX_BYTES = 400_000_000


def texts_of(docs: DataFrame, wanted: DataFrame, bound: int, max_bytes: int = MAX_BYTES) -> list[tuple[int, str, int]]:
    """Whole texts of at most bound wanted rows (doc_id, label), in the fixed order; max_bytes bounds them together.

    Only the ids are ordered over the cluster; the chosen ones, bounded, are then broadcast to one scan, which
    makes one row of each id (its smallest text) before anything reaches the driver.
    """
    chosen = wanted.orderBy(order_key(F.col("doc_id")), "doc_id").limit(bound)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    found = texts.join(F.broadcast(chosen), "doc_id").groupBy("doc_id").agg(F.min(F.struct("text", "label")).alias("r")).select("doc_id", "r.text", "r.label")
    rows, size = [], 0
    for r in found.orderBy(order_key(F.col("doc_id")), "doc_id").toLocalIterator():
        size += len(r["text"].encode("utf-8", "surrogatepass"))
        if rows and size > max_bytes:
            break
        rows.append((r["doc_id"], r["text"], r["label"]))
    return sorted(rows)
