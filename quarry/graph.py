"""Connected components of an edge list by alternating star contractions, with staged rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.session import staged


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One contraction of edges (u > v). Large: each node's larger neighbours are tied to its smallest
    neighbour; small: each node and its smaller neighbours are. Both keep components, and a
    node's neighbours are only ever aggregated to a minimum, never gathered. Minima are staged: the join
    that follows is dealt anew, and the partition of a star's centre can be split."""
    if large:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = staged(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "least")
        tied = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        least = staged(edges.groupBy("u").agg(F.min("v").alias("m")), "least")
        joined = edges.join(least, "u")
        tied = joined.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v")))
    return tied.where("u <> v").distinct()


def connected_components(edges: DataFrame, src: str = "src", dst: str = "dst", max_rounds: int = 60) -> DataFrame:
    """Edges of two long columns -> (node, component): the smallest node reachable, for every node with an edge.

    Edges may repeat, run either way or be loops; rows with a null end are passed over. A round costs
    six shuffles of the remaining edges; the number of rounds grows with the logarithm of the nodes.
    Rounds are staged in the shared folder, so a lost executor costs one round at most.
    """
    a, b = F.col(src).cast("long"), F.col(dst).cast("long")
    given = staged(edges.where(a.isNotNull() & b.isNotNull()).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct(), "edges")
    loops = given.where("u = v").select(F.col("u").alias("node"))
    now = given.where("u <> v")
    sums = [F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")]
    before = now.agg(*sums).first()
    for _ in range(max_rounds):
        now = staged(_star(_star(now, True), False), "stars")
        after = now.agg(*sums).first()
        if after == before:
            break
        before = after
    else:
        raise RuntimeError("components did not settle")
    roots = now.select(F.col("v").alias("node")).distinct()
    found = now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots.select("node", F.col("node").alias("component")))
    return found.unionByName(loops.join(found, "node", "left_anti").select("node", F.col("node").alias("component")))
