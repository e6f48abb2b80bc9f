"""Field-weighted BM25 search over a persisted index, one query or many at once, with hit rows, facets, phrases and snippets.

Statistics are those of the whole corpus; filters apply before the limit and do not change them. Terms are lower-cased
runs of letters and digits; a query token with an underscore is the phrase of its parts. The index is that of
quarry.operators.index.

Many queries are one pass: their terms meet the postings in one join, and a chunk keeps how often each of a query's tokens stands in each
field, so that any number of weights are scored from the same rows.
"""

from __future__ import annotations

import math
import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quarry.operators import index
from quarry.session import staged

K1, B = 1.2, 0.75
#: Weights of the indexed fields.
WEIGHTS = {"doc_title": 2.5, "title": 2.0, "section_path": 1.5, "body": 1.0}
#: Fixed value: characters below which a section may restate its child.
SHORT = 300
#: Different terms of many queries up to which they are pushed into the scan of the postings by name.
PUSHED = 2000
#: Rows (query, token, chunk) that a task of many searches scores, and weights of queries' tokens up to which all tasks get them.
SCORED, SENT = 500_000, 1_000_000

build_index = index.build


def query_terms(text: str) -> list[str]:
    """Tokens of at least two characters, duplicates kept; an underscore is part of a token."""
    return [t for t in re.findall(r"[A-Za-z0-9_]+", text) if len(t) >= 2]


def phrase(token: str) -> tuple[str, ...]:
    """The terms of a token or phrase, which must follow each other."""
    return tuple(re.findall(r"[^\W_]+", token.lower()))


def _times(unit: tuple[str, ...], weights: Sequence[float]) -> Column:
    """Weighted occurrences of a term or phrase among a chunk's collected (term, at)."""
    total = F.lit(0.0)
    for number, w in enumerate(weights):
        first, *more = (F.flatten(F.transform(F.filter("found", _is(t)), _places(number))) for t in unit)
        for k, there in enumerate(more, 1):
            first = F.filter(first, _follows(there, k))
        total = total + F.lit(float(w)) * F.size(first)
    return total


def _is(term: str):
    return lambda x: x["term"] == term


def _in_field(number: int):
    return lambda a: a["f"] == number


def _places(number: int):
    return lambda x: F.transform(F.filter(x["at"], _in_field(number)), lambda a: a["p"])


def _follows(there: Column, k: int):
    return lambda at: F.array_contains(there, at + k)


def _weights(ix: index.Index, weights: Mapping[str, float] | None) -> list[float]:
    """A weight for each field, in the index's order."""
    return [float((weights or ix.fields).get(f, 0.0)) for f in ix.fields]


def scores(spark: SparkSession, path: str, query: list[str], weights: Mapping[str, float] | None = None) -> DataFrame:
    """(key, score) of chunks that hold any query token or phrase; each repeat of one counts again.

    Only the postings of the query's terms are read; a chunk gathers at most one row for each of them.
    Chunks that hold a term are counted by the index; those that hold a phrase are counted here.
    """
    ix = index.Index(spark, path)
    key = ix.key
    units = [u for u in map(phrase, query) if u]
    wanted = sorted({t for u in units for t in u})
    if not wanted:
        return ix.chunks().select(key, F.lit(0.0).alias("score")).where(F.lit(False))
    found = ix.postings(wanted).groupBy(key).agg(F.collect_list(F.struct("term", "at")).alias("found"))
    want = sorted(set(units))
    counted = found.select(key, *[_times(u, _weights(ix, weights)).alias(f"f{k}") for k, u in enumerate(want)])
    n = {(r["term"],): r["n"] for r in ix.words(wanted).select("term", "n").collect()}
    phrases = [k for k, u in enumerate(want) if len(u) > 1]
    if phrases:
        one = counted.agg(*[F.count_if(F.col(f"f{k}") > 0).alias(f"n{k}") for k in phrases]).first()
        n |= {want[k]: one[f"n{k}"] for k in phrases}
    total = F.lit(0.0)
    for k, u in enumerate(want):
        holds = n.get(u, 0)
        rare = (ix.n - holds + 0.5) / (holds + 0.5)
        rare = math.log(rare) if rare > 1 else 1e-6
        f = F.col(f"f{k}")
        total = total + F.lit(float(units.count(u)) * rare) * f * (K1 + 1) / (f + K1 * (1 - B + B * F.col("d") / F.lit(float(ix.avgdl or 1.0))))
    lengths = ix.chunks().select(key, "d")
    some = " OR ".join(f"f{k} > 0" for k in range(len(want)))
    return counted.where(some).join(lengths, key).select(key, total.alias("score"))


def units_of(queries: DataFrame) -> DataFrame:
    """queries(query, text) -> (query, unit, parts, times): a query's tokens and phrases with their terms and repeats."""
    tokens = F.filter(F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit("([A-Za-z0-9_]+)"), F.lit(1)), lambda t: F.length(t) >= 2)
    each = queries.select("query", F.explode(tokens).alias("token")).select("query", F.regexp_extract_all(F.lower("token"), F.lit("([a-z0-9]+)"), F.lit(1)).alias("parts")).where("size(parts) > 0")
    return each.groupBy("query", F.array_join("parts", "_").alias("unit"), "parts").agg(F.count("*").alias("times"))


def scored(spark: SparkSession, path: str, queries: DataFrame, grid: Sequence[Mapping[str, float] | None] = (None,)) -> DataFrame:
    """queries(query, text) -> (query, key, scores): for each point of a grid of weights the score of every chunk that holds a token of the query."""
    ix = index.Index(spark, path)
    key, fields = ix.key, range(len(ix.fields))
    units = staged(units_of(queries), "query-units")
    each = units.select(F.col("unit").alias("_unit"), "parts").distinct().select("_unit", F.size("parts").alias("_size"), F.posexplode("parts").alias("_nth", "term"))
    wanted = [r["term"] for r in each.select("term").distinct().limit(PUSHED + 1).collect()]
    met = ix.postings(wanted if len(wanted) <= PUSHED else None).join(each, "term")
    times = lambda use: F.array(*[F.size(F.filter(use, _in_field(f))) for f in fields])
    one = met.where("_size = 1").select("_unit", key, times("at").alias("_tf"))
    long = met.where("_size > 1").groupBy("_unit", "_size", key).agg(F.sort_array(F.collect_list(F.struct("_nth", "at"))).alias("_x")).where("size(_x) = _size")
    runs = F.filter(F.col("_x")[0]["at"], lambda a: F.forall("_x", lambda y: F.exists(y["at"], lambda b: (b["f"] == a["f"]) & (b["p"] == a["p"] + y["_nth"]))))
    long = long.select("_unit", key, runs.alias("at")).where("size(at) > 0").select("_unit", key, times("at").alias("_tf"))
    hits = staged(one.unionByName(long), "query-hits")
    n = hits.groupBy("_unit").agg(F.count("*").alias("n"))
    odds = (ix.n - F.col("n") + 0.5) / (F.col("n") + 0.5)
    rare = staged(units.join(n, F.col("unit") == F.col("_unit")).select("query", "_unit", (F.col("times") * F.when(odds > 1, F.ln(odds)).otherwise(1e-6)).alias("_w"), "n"), "query-weights")
    size = rare.agg(F.count("*").alias("weights"), F.coalesce(F.sum("n"), F.lit(0)).alias("rows")).first()
    rare = rare.drop("n")
    whole = F.lit(K1) * (1 - B + B * F.col("d") / F.lit(float(ix.avgdl or 1.0)))

    def part(weights: list[float]) -> Column:
        """What a token adds to a chunk's score under one point's weights."""
        f = sum((F.lit(w) * F.col("_tf")[j] for j, w in enumerate(weights)), F.lit(0.0))
        return F.col("_w") * f * (K1 + 1) / (f + whole)

    points = [_weights(ix, g) for g in grid]
    # Hits are dealt by chunk, by as many tasks as their rows with all queries ask for: the product of queries and chunks is made, summed up and cut where it is.
    dealt = hits.repartition(max(spark.sparkContext.defaultParallelism, math.ceil(size["rows"] / SCORED)), key).join(ix.chunks().select(key, "d"), key)
    met = dealt.join(F.broadcast(rare) if size["weights"] <= SENT else rare, "_unit")
    parts = met.select("query", key, *[part(w).alias(f"_p{n}") for n, w in enumerate(points)])
    sums = parts.groupBy("query", key).agg(*[F.sum(f"_p{n}").alias(f"_p{n}") for n in range(len(points))])
    return sums.select("query", key, F.array(*[f"_p{n}" for n in range(len(points))]).alias("scores"))


def search_many(spark: SparkSession, path: str, queries: DataFrame, k: int = 10, grid: Sequence[Mapping[str, float] | None] = (None,), facets: DataFrame | None = None) -> DataFrame:
    """queries(query, text) -> (query, point, rank, key, score): the k best of each query and point of the grid; equal scores by key.

    facets(query, and a list of wanted values by facet, null: any) narrows a query before its limit; one not named stays open.
    The lists of ranks are cut before they are shuffled, so a task sends k rows for each query and point."""
    ix = index.Index(spark, path)
    found = scored(spark, path, queries, grid)
    if facets is not None:
        names = [c for c in facets.columns if c != "query"]
        wide = found.join(ix.chunks().select(ix.key, *names), ix.key).join(facets.select("query", *[F.col(c).alias(f"_{c}") for c in names]), "query", "left")
        for c in names:
            wide = wide.where(F.col(f"_{c}").isNull() | F.coalesce(F.array_contains(f"_{c}", F.col(c)), F.lit(False)))
        found = wide.select("query", ix.key, "scores")
    each = found.select("query", ix.key, F.posexplode("scores").alias("point", "score")).where("score > 0").withColumn("score", F.round("score", 4))
    place = F.row_number().over(Window.partitionBy("query", "point").orderBy(F.desc("score"), ix.key))
    return each.withColumn("rank", place).where(F.col("rank") <= k).select("query", "point", F.col("rank").cast("long").alias("rank"), ix.key, "score")


def search(spark: SparkSession, path: str, text: str | list[str], k: int = 10, facets: Mapping[str, list[str] | None] | None = None, expansions: Mapping[str, str] | None = None, weights: Mapping[str, float] | None = None) -> DataFrame:
    """The k best chunks with their rank, score and stored columns; facets narrow before the limit, equal scores go by key."""
    query = query_terms(text) if isinstance(text, str) else list(text)
    query += [p.replace(" ", "_") for p in expansion_clauses(query, expansions or {})]
    ix = index.Index(spark, path)
    key, chunks = ix.key, ix.chunks()
    found = scores(spark, path, query, weights)
    if any((facets or {}).values()):
        found = found.join(facet_filter(chunks, **(facets or {})).select(key), key, "left_semi")
    best = top_k(found, key, k)
    hits = chunks.join(F.broadcast(best), key)  # k rows
    place = F.row_number().over(_best_first(key)).cast("long")
    return hits.withColumn("rank", place).withColumn("score", F.round("score", 4)).drop("d")


def _best_first(key: str):
    return Window.orderBy(F.desc(F.round("score", 4)), key)  # over the k rows of a result


def top_k(found: DataFrame, key: str, k: int) -> DataFrame:
    """The k best; equal scores by key."""
    return found.orderBy(F.desc(F.round("score", 4)), key).limit(k)


def snippet(text: Column, wanted: list[str], width: int = 16) -> Column:
    """The window of width words that holds most query words (the first among equals), these in brackets, dots where text was cut."""
    words = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(r"(\S+)"), F.lit(1))
    low = [t.lower() for t in wanted]
    hit = lambda w: F.regexp_replace(F.lower(w), r"[^\p{L}\p{N}_]", "").isin(low)

    def cut(w: Column) -> Column:
        running = F.transform(F.array(F.transform(w, lambda x: hit(x).cast("int"))), lambda m: F.aggregate(m, F.array(F.lit(0)), lambda acc, x: F.concat(acc, F.array(F.element_at(acc, -1) + x))))[0]
        starts = F.sequence(F.lit(0), F.greatest(F.size(w) - width, F.lit(0)))
        best = F.transform(F.array(running), lambda r: F.array_max(F.transform(starts, lambda i: F.struct((F.get(r, F.least(i + width, F.size(w))) - F.get(r, i)).alias("n"), (-i).alias("at")))))[0]["at"]
        shown = F.transform(F.slice(w, 1 - best, F.lit(width)), lambda x: F.when(hit(x), F.concat(F.lit("["), x, F.lit("]"))).otherwise(x))
        return F.concat(F.when(best < 0, F.lit("… ")).otherwise(F.lit("")), F.array_join(shown, " "), F.when(F.size(w) > width - best, F.lit(" …")).otherwise(F.lit("")))

    return F.transform(F.array(words), cut)[0]


def demote_restating_parents(hits: list[dict], short: int = SHORT) -> list[dict]:
    """A short section whose direct child in the list restates its title gives the child its place and follows it.

    Titles restate each other where the words of one begin the other's. Works on the few rows of a result; a hit
    has section_id, section_title, section_path, body_len. Each hit comes out once: of two parents of one child the
    better placed has it.
    """
    words = lambda t: re.findall(r"[^\W_]+", (t or "").lower())

    def twins(a: str, b: str) -> bool:
        x, y = sorted((words(a), words(b)), key=len)
        return bool(x) and y[: len(x)] == x

    path = lambda h: (h["section_path"] or "").strip(" >")
    below = lambda p, c: path(c) == f"{path(p)} > {p['section_title']}".strip(" >")
    child_of: dict[int, int] = {}
    for i, h in enumerate(hits):
        if h["body_len"] < short:
            j = next((j for j, c in enumerate(hits) if j != i and j not in child_of.values() and below(h, c) and twins(h["section_title"], c["section_title"])), None)
            if j is not None:
                child_of[i] = j
    # A parent's group takes the parent's place; a child that is itself a parent brings its own child before it.
    grouped = set(child_of.values())

    def group(i: int) -> list[int]:
        return (group(child_of[i]) if i in child_of else []) + [i]

    return [hits[j] for i in range(len(hits)) if i not in grouped for j in group(i)]


def envelope(hits: list[dict]) -> dict:
    """Hits with their number; a warning stands in only when there are none."""
    found: dict = {"hits": hits, "hit_count": len(hits)}
    if not hits:
        found["warning"] = "no results"
    return found


def expansion_clauses(tokens: list[str], expansions: Mapping[str, str]) -> list[str]:
    """Phrases of at least two words for tokens of at least three characters, each once."""
    phrases = (expansions.get(t.upper(), "").lower() for t in tokens if len(t) >= 3)
    return list(dict.fromkeys(p for p in phrases if len(p.split()) >= 2))


def expansion_map(entities: DataFrame) -> DataFrame:
    """entities(canonical, canonical_name) -> (key, phrase): usable expansions."""
    key, name = F.upper("canonical"), F.trim("canonical_name")
    usable = key.rlike(r"^[A-Z0-9]{3,}$") & (F.size(F.split(name, r"\s+")) >= 2)
    return entities.where(usable).groupBy(key.alias("key")).agg(F.min(name).alias("phrase"))


def facet_filter(rows: DataFrame, **facets: list[str] | None) -> DataFrame:
    """Rows that match every given facet, any of its values; facets not given do not narrow."""
    for name, values in facets.items():
        if values:
            rows = rows.where(F.col(name).isin(values))
    return rows
