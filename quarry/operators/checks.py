"""Soundness checks of a corpus: integrity, enumerations, counts, lineage and bundles."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def violations(name: str, found: DataFrame, bad: str = "FAIL") -> DataFrame:
    """(name, violations, health) of a frame of offending rows: one aggregation."""
    return found.agg(F.count("*").alias("violations")).select(F.lit(name).alias("name"), "violations", F.when(F.col("violations") == 0, "PASS").otherwise(bad).alias("health"))


def report(checks: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, checks)


def orphans(child: DataFrame, key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Rows whose non-null key no parent has."""
    return child.where(F.col(key).isNotNull()).join(parent.select(F.col(parent_key).alias(key)), key, "left_anti")


def unknown_values(rows: DataFrame, column: str, known: list[str]) -> DataFrame:
    return rows.select(column).where(F.coalesce(column, F.lit("")) != "").distinct().where(~F.col(column).isin(known))


def bundle_integrity(listed: DataFrame, present: DataFrame, path: str, digest: str) -> DataFrame:
    """(path, finding): missing, extra or mismatch; sound parts are not told."""
    a, b = listed.select(path, F.col(digest).alias("_a")), present.select(path, F.col(digest).alias("_b"))
    both = a.join(b, path, "full_outer")
    finding = F.when(F.col("_b").isNull(), "missing").when(F.col("_a").isNull(), "extra").when(F.col("_a") != F.col("_b"), "mismatch")
    return both.select(path, finding.alias("finding")).where("finding IS NOT NULL")


def bundle_digest(parts: DataFrame, group: str, path: str, digest: str) -> DataFrame:
    """(group, digest): SHA-256 over the sorted "path:digest" lines of a bundle."""
    line = F.concat_ws(":", F.col(path).cast("string"), digest)
    return parts.groupBy(group).agg(F.sha2(F.array_join(F.array_sort(F.collect_list(line)), "\n"), 256).alias("digest"))


def count_drops(before: DataFrame, after: DataFrame, kind: str, ratio: float) -> DataFrame:
    """(kind, before, after, finding): zero or dropped below the ratio of before."""
    b, a = before.groupBy(kind).agg(F.count("*").alias("before")), after.groupBy(kind).agg(F.count("*").alias("after"))
    both = b.join(a, kind, "left").withColumn("after", F.coalesce("after", F.lit(0)))
    return both.withColumn("finding", F.when(F.col("after") == 0, "zero").when(F.col("after") < ratio * F.col("before"), "drop").otherwise("ok"))


def departures(before: DataFrame, after: DataFrame, key: str, group: str, acknowledged: list[str]) -> DataFrame:
    """(group, n) of keys that left, for groups that nobody acknowledged."""
    gone = before.join(after.select(key), key, "left_anti").where(~F.col(group).isin(acknowledged))
    return gone.groupBy(group).agg(F.count("*").alias("n"))


def fetch_state(attempts: DataFrame, key: str, ok: Column, failed: Column, most: int = 3) -> DataFrame:
    """(key, action): skip what was fetched or has failed too often, fetch the rest."""
    per = attempts.groupBy(key).agg(F.coalesce(F.bool_or(ok), F.lit(False)).alias("_ok"), F.count_if(failed).alias("_failed"))
    return per.select(key, F.when(F.col("_ok"), "fetched").when(F.col("_failed") >= most, "permanent").otherwise("fetch").alias("action"))


def retain(current: DataFrame, prior: DataFrame, key: str) -> DataFrame:
    """current, and what prior has besides, as it was."""
    return current.unionByName(prior.join(current.select(key), key, "left_anti").select(*current.columns))


def undeclared(live: DataFrame, declared: DataFrame, column: str) -> DataFrame:
    """Values that occur without being declared."""
    return live.select(column).distinct().join(declared.select(column).distinct(), column, "left_anti")


def tree_hash(rows: DataFrame, group: str, name: str, content: str) -> DataFrame:
    """(group, digest): SHA-256 over the sorted "name<tab>digest" lines of a group's files."""
    line = F.concat_ws("\t", F.col(name).cast("string"), F.sha2(F.col(content).cast("string"), 256))
    return rows.groupBy(group).agg(F.sha2(F.array_join(F.sort_array(F.collect_list(line)), "\n"), 256).alias("digest"))


def inventory_gate(rows: DataFrame, key: str, noise: str, kinds: list[str], required: list[str], crawled: int | None) -> DataFrame:
    """(check, violations, ok) of an inventory: as many rows as were crawled, known kinds of noise, nothing required empty, some genuine."""
    aggs = [F.count_if(~F.coalesce(F.col(noise).isin(kinds), F.lit(False))).alias("noise")] + [F.count_if(F.coalesce(F.col(c).cast("string"), F.lit("")) == "").alias(c) for c in required]
    one = rows.agg(F.count("*").alias("n"), F.count_if(F.col(noise) == "").alias("genuine"), *aggs)
    told = [F.struct(F.lit("one_to_one").alias("check"), F.abs(F.col("n") - F.lit(crawled)).alias("violations"))] if crawled is not None else []
    told += [F.struct(F.lit("noise_kind").alias("check"), F.col("noise").alias("violations")), F.struct(F.lit("some_genuine").alias("check"), F.when(F.col("genuine") > 0, 0).otherwise(1).cast("long").alias("violations"))]
    told += [F.struct(F.lit(f"has_{c}").alias("check"), F.col(c).alias("violations")) for c in required]
    return one.select(F.explode(F.array(*told)).alias("x")).select("x.check", "x.violations", (F.col("x.violations") == 0).alias("ok"))


def retention_gate(scored: DataFrame, key: str, signed: DataFrame) -> DataFrame:
    """(key, finding, blocks) of scored(key, verdict) and signed(key): quarantined always blocks, review without a signature
    and no verdict do; a signature that nothing needs is stale and does not block."""
    both = scored.select(key, "verdict", F.lit(True).alias("_scored")).join(signed.select(key, F.lit(True).alias("_signed")).distinct(), key, "full_outer")
    bare = F.coalesce("verdict", F.lit("")) == ""
    finding = (
        F.when(F.col("_scored").isNotNull() & bare, "unscored")
        .when(F.col("verdict") == "QUARANTINE", "quarantined")
        .when((F.col("verdict") == "REVIEW") & F.col("_signed").isNull(), "review_unsigned")
        .when(F.col("_signed") & (F.col("_scored").isNull() | ~F.col("verdict").isin("REVIEW", "QUARANTINE")), "signoff_stale")
    )
    return both.select(key, finding.alias("finding")).where("finding IS NOT NULL").withColumn("blocks", F.col("finding") != "signoff_stale")


def lineage_check(members: DataFrame, group: str, bodies: DataFrame, retained: DataFrame | None = None) -> DataFrame:
    """(group, finding) of members(group, is_latest, body_sha256) against bodies(group, body): exactly one latest member, which
    records the body's digest; with retained(body_sha256) every member's body must still be kept, which is looked at first."""
    latest = F.col("is_latest")
    one = members.groupBy(group).agg(F.count_if(latest).alias("latest"), F.max(F.when(latest, F.coalesce("body_sha256", F.lit("")))).alias("recorded"))
    told = bodies.select(group, F.sha2("body", 256).alias("actual")).join(one, group, "left")
    finding = F.when(F.coalesce("latest", F.lit(0)) != 1, "unverifiable").when(F.col("recorded") == "", "unverifiable").when(F.col("recorded") != F.col("actual"), "stale")
    found = told.select(group, finding.alias("finding")).where("finding IS NOT NULL")
    if retained is None:
        return found
    lost = members.where("body_sha256 <> ''").join(retained.select("body_sha256").distinct(), "body_sha256", "left_anti").select(group, F.lit("body_lost").alias("finding")).distinct()
    return lost.unionByName(found.join(lost, group, "left_anti"))


def error_gate(rows: DataFrame, error: str, most: float = 0.5) -> DataFrame:
    """(errors, total, ok): fails where more than a share of the documents failed."""
    one = rows.agg(F.count(error).alias("errors"), F.count("*").alias("total"))
    return one.select("errors", "total", (F.col("errors") <= F.col("total") * most).alias("ok"))


def contract_problems(emitted: dict[str, list[str]], version: str, spec: dict) -> list[str]:
    """Where published views differ from their contract ({"version", "views": {view: columns}}): exact views, columns and version."""
    want = spec["views"]
    problems = [f"view {v} missing" for v in sorted(want.keys() - emitted.keys())] + [f"view {v} not in contract" for v in sorted(emitted.keys() - want.keys())]
    problems += [f"view {v}: columns {emitted[v]} instead of {list(want[v])}" for v in sorted(want.keys() & emitted.keys()) if list(emitted[v]) != list(want[v])]
    return problems + ([] if version == spec["version"] else [f"version {version} instead of {spec['version']}"])
