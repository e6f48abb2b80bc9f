"""Stages of a corpus build: order by what they need, selection of ranges, and runs that are skipped while nothing changed."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from graphlib import CycleError, TopologicalSorter

from pyspark.sql import DataFrame, SparkSession

from quarry.operators import stores


@dataclass(frozen=True)
class Stage:
    """A named step: reads tables by name, and returns those that it makes. On demand: only run when asked for by name."""

    name: str
    requires: tuple[str, ...]
    produces: tuple[str, ...]
    run: Callable[[Mapping[str, DataFrame]], Mapping[str, DataFrame]]
    optional: tuple[str, ...] = ()
    version: int = 1
    on_demand: bool = False


@dataclass
class Report:
    ran: list[str] = field(default_factory=list)
    skipped: list[str] = field(default_factory=list)


def order(stages: Sequence[Stage]) -> list[Stage]:
    """Stages after those that make what they need; names settle what is left open."""
    by, maker = {s.name: s for s in stages}, {t: s.name for s in stages for t in s.produces}
    work = TopologicalSorter({s.name: {maker[t] for t in (*s.requires, *s.optional) if t in maker and maker[t] != s.name} for s in stages})
    try:
        work.prepare()
    except CycleError as e:
        raise ValueError(f"stages need each other: {sorted(set(e.args[1]))}") from None
    out: list[Stage] = []
    while work.is_active():
        ready = sorted(work.get_ready())
        out += [by[n] for n in ready]
        work.done(*ready)
    return out


def select(stages: Sequence[Stage], first: str | None = None, last: str | None = None, only: str | None = None) -> list[Stage]:
    """A range of the order, without what runs on demand; or one stage by name."""
    placed = order(stages)
    names = [s.name for s in placed]
    unknown = [n for n in (first, last, only) if n is not None and n not in names]
    if unknown:
        raise ValueError(f"unknown stage {unknown[0]}")
    if only:
        return [placed[names.index(only)]]
    return [s for s in placed[names.index(first) if first else 0 : names.index(last) + 1 if last else None] if not s.on_demand]


def build(spark: SparkSession, home: str, stages: Sequence[Stage], sources: Mapping[str, DataFrame], force: bool = False, verify: Callable[[str, Mapping[str, DataFrame]], str | None] | None = None, **chosen: str | None) -> Report:
    """Run the chosen stages over tables stored below home.

    A stage is skipped if the digests of what it reads, its version and what it made are those of its last run: outputs that
    someone changed since are made again. A required table that is missing stops the build before the stage; verify may
    refuse what a stage made, which then is not recorded."""
    report = Report()

    def stored(name: str) -> DataFrame | None:
        if name in sources:
            return sources[name]
        return stores.read_table(spark, f"{home}/{name}") if stores.current(spark, f"{home}/{name}") else None

    log = f"{home}/_runs"
    for stage in select(stages, **chosen):
        given = {t: stored(t) for t in (*stage.requires, *stage.optional)}
        missing = [t for t in stage.requires if given[t] is None]
        if missing:
            raise ValueError(f"{stage.name} needs {missing[0]}")
        given = {t: df for t, df in given.items() if df is not None}
        read = ";".join([f"v{stage.version}"] + [f"{t}={stores.digest_of(df)}" for t, df in sorted(given.items())])
        made = lambda s=stage: ";".join(f"{t}={stores.digest_of(df) if (df := stored(t)) is not None else None}" for t in s.produces)
        runs = {r["stage"]: r for r in stores.read_table(spark, log).collect()} if stores.current(spark, log) else {}  # a row a stage
        last = runs.get(stage.name)
        if not force and last and (last["read"], last["made"]) == (read, made()):
            report.skipped.append(stage.name)
            continue
        found = stage.run(given)
        refused = verify(stage.name, found) if verify else None
        if refused or set(found) != set(stage.produces):
            raise ValueError(f"{stage.name}: {refused or 'does not make what it says'}")
        for t, df in found.items():
            stores.replace_table(df, f"{home}/{t}")
        rows = [(n, r["read"], r["made"]) for n, r in runs.items() if n != stage.name] + [(stage.name, read, made())]
        stores.replace_table(spark.createDataFrame(rows, "stage string, read string, made string").coalesce(1), log)
        report.ran.append(stage.name)
    return report
