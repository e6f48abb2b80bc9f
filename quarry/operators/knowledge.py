"""A store of knowledge nodes and their relationships that fresh runs are merged into.

Every run resolves nodes anew. A merge keeps what people verified: a verified node keeps its facts whatever a run says, and what the run would
have changed is kept beside it as a conflict; a rejected one stays rejected. Unverified nodes take the facts of the run, and are
retired when a run no longer has them. Relationships are closed, not removed, when a run no longer has them or an end is retired or
rejected, unless they are verified and both ends stand. Each row names the runs that said it.

Nodes and relationships of a merge are one version of the store, swapped in together.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.operators import stores

STATE = ("status", "verification", "runs", "conflict", "closed_by")


def _facts(names: Sequence[str], prefix: str = "") -> Column:
    return F.to_json(F.struct(*[F.col(prefix + n).alias(n) for n in names]), {"ignoreNullFields": "false"})


def _merged(stored: DataFrame | None, fresh: DataFrame, key: Sequence[str], facts: Sequence[str], run: str) -> DataFrame:
    """Full outer join by key; one row a key. fresh must have distinct keys."""
    new = fresh.select(*key, *[F.col(f).alias(f"_{f}") for f in facts], F.lit(True).alias("_new"))
    if stored is None:
        empty = [F.lit(None).cast(fresh.schema[f].dataType).alias(f) for f in facts]
        kinds = {"runs": "array<string>"}
        joined = new.select("*", *empty, *[F.lit(None).cast(kinds.get(c, "string")).alias(c) for c in STATE], F.lit(None).cast("boolean").alias("_old"))
    else:
        joined = stored.withColumn("_old", F.lit(True)).join(new, list(key), "full")
    held, said = F.col("_old").isNotNull(), F.col("_new").isNotNull()
    fixed = held & F.coalesce(F.col("verification").isin("verified", "rejected"), F.lit(False))
    differs = said & fixed & (_facts(facts) != _facts(facts, "_")) if facts else F.lit(False)
    runs = F.array_distinct(F.concat(F.coalesce("runs", F.array().cast("array<string>")), F.when(said, F.array(F.lit(run))).otherwise(F.array().cast("array<string>"))))
    taken = [F.when(said & ~fixed, F.col(f"_{f}")).otherwise(F.col(f)).alias(f) for f in facts]
    status = F.when(F.coalesce("verification", F.lit("")) == "rejected", "rejected").when(said | fixed, "active").otherwise("retired")
    closed = F.when(status == "active", None).otherwise(F.coalesce("closed_by", F.lit(run)))
    conflict = F.when(differs, _facts(facts, "_")).when(said, None).otherwise(F.col("conflict"))
    return joined.select(*key, *taken, status.alias("status"), F.coalesce("verification", F.lit("unverified")).alias("verification"), runs.alias("runs"), conflict.alias("conflict"), closed.alias("closed_by"), F.col("closed_by").alias("_before"))


def merge_nodes(stored: DataFrame | None, fresh: DataFrame, facts: Sequence[str], run: str) -> DataFrame:
    """stored(node, facts, status, verification, runs, conflict, closed_by), fresh(node, facts; distinct nodes, null ones left out) -> stored's columns."""
    return _merged(stored, fresh.where("node IS NOT NULL"), ["node"], facts, run).drop("_before")


def merge_edges(stored: DataFrame | None, fresh: DataFrame, nodes: DataFrame, run: str) -> DataFrame:
    """stored(src, rel, dst, status, verification, runs, conflict, closed_by), fresh(src, rel, dst), merged nodes -> stored's columns.

    What leads to or from a node that is not active is closed; fresh rows whose ends the store does not know are left out."""
    named = nodes.select("node", F.col("status").alias("_status"))
    known = fresh.distinct().join(named.select(F.col("node").alias("src")), "src", "left_semi").join(named.select(F.col("node").alias("dst")), "dst", "left_semi")
    rows = _merged(stored, known.select("src", "rel", "dst"), ["src", "rel", "dst"], [], run)
    for end in ("src", "dst"):
        rows = rows.join(named.select(F.col("node").alias(end), F.col("_status").alias(f"_{end}")), end, "left")
    stands = (F.coalesce("_src", F.lit("")) == "active") & (F.coalesce("_dst", F.lit("")) == "active")
    status = F.when(F.col("status") == "rejected", "rejected").when(stands & (F.col("status") == "active"), "active").otherwise("closed")
    closed = F.when(status == "active", None).otherwise(F.coalesce("_before", "closed_by", F.lit(run)))
    return rows.select("src", "rel", "dst", status.alias("status"), "verification", "runs", "conflict", closed.alias("closed_by"))


def read(spark: SparkSession, home: str) -> tuple[DataFrame, DataFrame] | None:
    """The store's nodes and relationships, None before the first run."""
    path = stores.current(spark, home)
    return None if path is None else (spark.read.parquet(f"{path}/nodes"), spark.read.parquet(f"{path}/edges"))


def _write(spark: SparkSession, home: str, nodes: DataFrame, edges) -> None:
    path = stores.new_version(home)
    nodes.write.parquet(f"{path}/nodes")
    edges(spark.read.parquet(f"{path}/nodes")).write.parquet(f"{path}/edges")
    stores.swap(spark, home, path)


def run(nodes: DataFrame, edges: DataFrame, home: str, name: str, facts: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Merge a run into the store below home; returns its nodes and relationships."""
    spark = nodes.sparkSession
    held = read(spark, home)
    merged = merge_nodes(held[0] if held else None, nodes, facts, name)
    _write(spark, home, merged, lambda stored: merge_edges(held[1] if held else None, edges, stored, name))
    return read(spark, home)


def verify(spark: SparkSession, home: str, verdicts: DataFrame) -> None:
    """Enter verdicts(node, verification: verified, rejected or unverified) of people; a rejected node and its relationships count no more."""
    nodes, edges = read(spark, home)
    told = nodes.join(verdicts.select("node", F.col("verification").alias("_said")), "node", "left").withColumn("verification", F.coalesce("_said", "verification"))
    status = F.when(F.col("verification") == "rejected", "rejected").when(F.col("status") == "rejected", "active").otherwise(F.col("status"))
    told = told.withColumn("status", status).withColumn("closed_by", F.when(F.col("status") == "rejected", F.coalesce("closed_by", F.lit("verdict"))).when(F.col("status") == "active", None).otherwise(F.col("closed_by")))
    cut = lambda stored: _cut(edges, stored)
    _write(spark, home, told.select(*nodes.columns), cut)


def _cut(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """Relationships of nodes that are not active are closed by verdict."""
    gone = nodes.where("status <> 'active'").select("node")
    ends = edges.join(gone.select(F.col("node").alias("src"), F.lit(True).alias("_a")), "src", "left").join(gone.select(F.col("node").alias("dst"), F.lit(True).alias("_b")), "dst", "left")
    hit = F.coalesce("_a", "_b").isNotNull() & (F.col("status") == "active")
    return ends.withColumn("closed_by", F.when(hit, "verdict").otherwise(F.col("closed_by"))).withColumn("status", F.when(hit, "closed").otherwise(F.col("status"))).select(*edges.columns)
