"""Version groups: the latest member, lineage, append-only history and differences of snapshots."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def lineage(members: DataFrame, group: list[str], order: list[str], key: str) -> DataFrame:
    """members plus rank (1 is oldest) and is_latest; equal orders by key, nulls first."""
    rising = [F.col(c).asc_nulls_first() for c in (*order, key)]
    by = Window.partitionBy(*group)
    return members.withColumn("rank", F.row_number().over(by.orderBy(*rising)).cast("long")).withColumn("is_latest", F.col("rank") == F.count("*").over(by))


def merge_history(existing: DataFrame, fresh: DataFrame, key: str, body: str) -> DataFrame:
    """Union by key that loses nothing: a changed body takes the fresh facts and moves the prior body to superseded.

    Both frames have key and body; existing also superseded (array of bodies). Merging again changes nothing.
    """
    e, f = existing.select(key, F.col(body).alias("_old"), "superseded"), fresh.select(key, F.col(body).alias("_new"))
    both = e.join(f, key, "full_outer")
    changed = F.col("_old").isNotNull() & F.col("_new").isNotNull() & (F.col("_old") != F.col("_new"))
    none = F.array().cast("array<string>")
    kept = F.coalesce(F.col("superseded"), none)
    return both.select(key, F.coalesce("_new", "_old").alias(body), F.when(changed, F.array_distinct(F.concat(kept, F.array("_old")))).otherwise(kept).alias("superseded"))


def snapshot_delta(before: DataFrame, after: DataFrame, key: str, name: str, status: str, ratio: float = 0.05, floor: int = 10) -> DataFrame:
    """(key, change): arrived, departed, renamed, moved. Moves are held back as "suspect" when there are
    at least ``floor`` of them and they are more than ``ratio`` of what both snapshots have."""
    b, a = before.select(key, F.col(name).alias("_n0"), F.col(status).alias("_s0"), F.lit(True).alias("_was")), after.select(key, F.col(name).alias("_n1"), F.col(status).alias("_s1"), F.lit(True).alias("_is"))
    both = b.join(a, key, "full_outer")
    held = F.col("_was") & F.col("_is")
    kinds = F.array_compact(F.array(F.when(F.col("_was").isNull(), "arrived"), F.when(F.col("_is").isNull(), "departed"), F.when(held & ~F.col("_n0").eqNullSafe(F.col("_n1")), "renamed"), F.when(held & ~F.col("_s0").eqNullSafe(F.col("_s1")), "moved")))
    changes = both.select(key, F.explode(kinds).alias("change"))
    # One row: the tripwire.
    trip = both.agg(F.count_if(held & ~F.col("_s0").eqNullSafe(F.col("_s1"))).alias("_moves"), F.count_if(held).alias("_common"))
    suspect = (F.col("change") == "moved") & (F.col("_moves") >= floor) & (F.col("_moves") > ratio * F.col("_common"))
    return changes.crossJoin(F.broadcast(trip)).select(key, F.when(suspect, "suspect").otherwise(F.col("change")).alias("change"))


def latest_state(events: DataFrame, key: str, at: str, values: list[str]) -> DataFrame:
    """The values of each key's last row by time; equal times by the largest values."""
    return events.groupBy(key).agg(F.max(F.struct(at, *values)).alias("x")).select(key, *[F.col(f"x.{c}").alias(c) for c in (at, *values)])


def reconcile(sets: dict[str, DataFrame], key: str) -> DataFrame:
    """(finding, key): members of each set that the next in the chain lacks, and the other way round."""
    names = list(sets)
    out = None
    for a, b in zip(names, names[1:], strict=False):
        for x, y in ((a, b), (b, a)):
            part = sets[x].select(key).distinct().join(sets[y].select(key), key, "left_anti").select(F.lit(f"{x}-{y}").alias("finding"), key)
            out = part if out is None else out.unionByName(part)
    return out


def group_key(anchor: Column, doc_id: Column) -> Column:
    return F.coalesce(F.nullif(anchor, F.lit("")), doc_id)


def snapshot_names(rows: DataFrame, day: str, order: str) -> DataFrame:
    """rows with name: the day for its first snapshot, then day-2, day-3 and so on."""
    nth = F.row_number().over(Window.partitionBy(day).orderBy(order))
    return rows.withColumn("name", F.when(nth == 1, F.col(day)).otherwise(F.concat(F.col(day), F.lit("-"), nth.cast("string"))))


def changed_snapshots(rows: DataFrame, key: str, order: list[str], digest: str) -> DataFrame:
    """Snapshots that are kept: the first of each key, and each that differs from the one before (a reversion does)."""
    before = F.lag(digest).over(Window.partitionBy(key).orderBy(*order))
    return rows.withColumn("_before", before).where(~F.col(digest).eqNullSafe(F.col("_before"))).drop("_before")


def revision_summary(rows: DataFrame, key: str, said: str) -> DataFrame:
    """(key, n, first, last): how many revisions, and the range of those dated YYYY-MM."""
    dated = F.when(F.col(said).rlike("^[0-9]{4}-[0-9]{2}$"), F.col(said))
    return rows.groupBy(key).agg(F.count("*").alias("n"), F.min(dated).alias("first"), F.max(dated).alias("last"))
