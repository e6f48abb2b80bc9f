"""A training-data pipeline over documents: each stage calls one operator and works on all that came before.

STAGES lists (name, function); a function takes (spark, docs, sf_dir). All but the last return the
columns of documents; the last returns packed pieces.

Defined results for odd input, in every stage: columns beyond those of documents are dropped, whatever their names; nulls
in any column stay; rows without an id are kept like others; an empty table gives an empty one. A null or empty text is
never toxic by its words, is a near-duplicate of all other wordless texts, holds no passage and no personal data, and packs
as the closing id alone. Repeated rows are near-duplicates of each other. Texts are used whole, however long.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm import decontaminate, packing, pii, simhash, toxicity
from quarry.session import staged, table

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject; without toxic labels none is."""
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs.select(*COLUMNS), model).where("predicted = 0").select(*COLUMNS)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near-duplicates: that with the smallest id, rows without id last; of rows with
    the same id that with the smallest hash of its text, and of equal rows any one. Ids may repeat or be null."""
    rows = staged(docs.select(*COLUMNS).withColumn("row", F.monotonically_increasing_id()), "pipeline-rows")
    marked = staged(simhash.fingerprints(rows.withColumn("hash", F.xxhash64("text")), "hash", "row"), "row-fingerprints")
    place = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "hash", "row")
    rooted = simhash.roots(staged(marked.groupBy("fp").agg(F.min(place).alias("first_id")), "fingerprint-rows"))
    kept = rooted.groupBy("root").agg(F.min("first_id").alias("first")).select(F.col("first.row").alias("row"))
    return rows.join(kept, "row", "left_semi").select(*COLUMNS)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark: no whole window of 13 words, and hit words below a twentieth."""
    return decontaminate.drop_contaminated(docs.select(*COLUMNS), table(spark, sf_dir, "benchmark"))


def redact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data blanked; n_chars is that of the new text."""
    docs = docs.select(*COLUMNS)
    done = pii.redact(docs, pii.train(docs))
    return done.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.char_length("text").cast("long"))).select(*COLUMNS)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of all documents, packed."""
    return packing.pack(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("pii", redact),
    ("packing", pack),
]

#: Trained classifiers and tokens: not for SQL; tests/llm holds the run against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = staged(docs, f"pipeline-{name}")
    return docs
