"""Measures of ranked results and retention."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quarry.operators import search
from quarry.session import staged


def ranking_metrics(ranked: DataFrame, judged: DataFrame, k: int = 10) -> DataFrame:
    """ranked(query, item, rank) and judged(query, item, grade) -> query, ndcg, rr, recall.

    Gain 2^grade - 1, discount log2(rank + 1); the ideal is over all judged items; queries without
    a positive grade are left out.
    """
    return _measured(ranked, judged, _ideal(judged, k), ["query"], k)


_GAIN = "pow(2.0D, grade) - 1"


def _grades(judged: DataFrame) -> DataFrame:
    """(query, grade, n, item): how many items have each positive grade of a query, and the smallest: counted where the rows are, none is sorted."""
    return judged.where("grade > 0").groupBy("query", "grade").agg(F.count("*").alias("n"), F.min("item").alias("item"))


def _ideal(judged: DataFrame, k: int) -> DataFrame:
    """(query, idcg, relevant): items of one grade stand in a row, so that their number says which of the k first places they have; of a query
    the k best grades are put in order."""
    grades, best_first = _grades(judged), Window.partitionBy("query").orderBy(F.desc("grade"))
    top = grades.withColumn("nth", F.row_number().over(best_first)).where(F.col("nth") <= k)
    before = F.coalesce(F.sum("n").over(best_first.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    places = F.when(F.col("before") < k, F.sequence(F.col("before") + 1, F.least(F.col("before") + F.col("n"), F.lit(k).cast("long"))))
    gain = F.aggregate(places, F.lit(0.0), lambda total, p: total + F.expr(_GAIN) / F.log2(p + 1))
    best = top.withColumn("before", before).groupBy("query").agg(F.sum(gain).alias("idcg"))
    return best.join(grades.groupBy("query").agg(F.sum("n").alias("relevant")), "query")


def _measured(ranked: DataFrame, judged: DataFrame, ideal: DataFrame, by: list[str], k: int) -> DataFrame:
    """ranked with its keys in by, ideal(by, idcg, relevant) -> (by, ndcg, rr, recall)."""
    hits = ranked.where(F.col("rank") <= k).join(judged.where("grade > 0"), ["query", "item"])
    got = hits.groupBy(*by).agg(F.sum(F.expr(_GAIN) / F.log2(F.col("rank") + 1)).alias("dcg"), F.min("rank").alias("first"), F.count("*").alias("found"))
    zero = lambda c: F.coalesce(c, F.lit(0.0))
    ndcg, rr, recall = zero(F.col("dcg") / F.col("idcg")), zero(1 / F.col("first")), zero(F.col("found") / F.col("relevant"))
    return ideal.join(got, by, "left").select(*by, F.round(ndcg, 6).alias("ndcg"), F.round(rr, 6).alias("rr"), F.round(recall, 6).alias("recall"))


def redundancy(ranked: DataFrame, texts: DataFrame, similar: float, shingled: Column, k: int = 10) -> DataFrame:
    """ranked(query, item, rank), texts(item, ...) -> query, redundancy: the share of the first k that is near a better one."""
    from quarry.operators.neardup import jaccard

    rows = ranked.where(F.col("rank") <= k).join(texts.select("item", shingled.alias("s")), "item")
    a, b = rows.select("query", F.col("rank").alias("ra"), F.col("s").alias("sa")), rows.select("query", F.col("rank").alias("rb"), F.col("s").alias("sb"))
    near = a.join(b, "query").where((F.col("rb") < F.col("ra")) & (jaccard(F.col("sa"), F.col("sb")) >= similar)).select("query", F.col("ra").alias("rank")).distinct()
    n, m = rows.groupBy("query").agg(F.count("*").alias("n")), near.groupBy("query").agg(F.count("*").alias("m"))
    return n.join(m, "query", "left").select("query", F.round(F.coalesce("m", F.lit(0)) / F.col("n"), 6).alias("redundancy"))


def retention(before: Column, after: Column, moved: Column, pass_at: float = 0.8, quarantine_at: float = 0.5) -> Column:
    """(score, verdict) of how many words a rewrite kept; an empty source passes."""
    score = F.when(before == 0, 1.0).otherwise(F.least(F.lit(1.0), (after + moved) / before))
    return F.struct(F.round(score, 6).alias("score"), F.when(score >= pass_at, "PASS").when(score >= quarantine_at, "REVIEW").otherwise("QUARANTINE").alias("verdict"))


def content_hash(rows: DataFrame, columns: list[str]) -> DataFrame:
    """One digest of a table that does not depend on the order of rows and tells null from the empty string.

    Each row is hashed where it is, rows are summed up by 4096 buckets, and only the buckets' digests meet.
    """
    cells = [F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("~")) for c in columns]
    digest = F.sha2(F.concat_ws("\x1f", *cells), 256)
    parts = rows.select(digest.alias("d")).groupBy(F.substring("d", 1, 3).alias("bucket")).agg(F.sum(F.conv(F.substring("d", 4, 14), 16, 10).cast("decimal(38,0)")).alias("s"), F.count("*").alias("n"))
    return parts.agg(F.sha2(F.array_join(F.array_sort(F.collect_list(F.concat_ws(":", "bucket", F.col("s").cast("string"), F.col("n").cast("string")))), "\n"), 256).alias("digest"), F.coalesce(F.sum("n"), F.lit(0)).alias("n"))


def metrics_by_point(ranked: DataFrame, judged: DataFrame, points: int, k: int = 10) -> DataFrame:
    """ranked(query, point, item, rank), judged(query, item, grade) -> (query, point, ndcg, rr, recall) for every judged query and point."""
    ideal = _ideal(judged, k).withColumn("point", F.explode(F.sequence(F.lit(0), F.lit(points - 1))))
    return _measured(ranked.select("query", "point", "item", "rank"), judged, ideal, ["query", "point"], k)


def golden_scores(spark: SparkSession, path: str, queries: DataFrame | list[tuple[str, str]], judged: DataFrame, k: int = 10, grid: Sequence[Mapping[str, float] | None] = (None,), facets: DataFrame | None = None) -> DataFrame:
    """queries(query, text), judged(query, item, grade) -> (query, point, ndcg, rr, recall) over an index, all queries and points in one pass; facets
    narrow queries as in search_many()."""
    if not isinstance(queries, DataFrame):
        queries = spark.createDataFrame(queries, "query string, text string")
    ranked = search.search_many(spark, path, queries, k, grid, facets)
    key = next(c for c in ranked.columns if c not in ("query", "point", "rank", "score"))
    return metrics_by_point(ranked.withColumnRenamed(key, "item"), judged, len(grid), k)


def sweep(spark: SparkSession, path: str, queries: DataFrame | list[tuple[str, str]], judged: DataFrame, grid: Sequence[Mapping[str, float]], k: int = 10) -> DataFrame:
    """(point, ndcg, delta, improved, regressed, worst, regressed_queries, adopt) of each point of a grid of weights against the first.

    A point is to be adopted only if its mean is better and no query is worse. The list of worse queries is as long as the
    judged set at most."""
    scored = staged(golden_scores(spark, path, queries, judged, k, grid), "sweep")
    shipped = scored.where("point = 0").select("query", F.col("ndcg").alias("shipped"))
    both = scored.join(shipped, "query").withColumn("change", F.col("ndcg") - F.col("shipped"))
    better, worse = F.col("change") > 1e-9, F.col("change") < -1e-9
    told = both.groupBy("point").agg(
        F.round(F.avg("ndcg"), 6).alias("ndcg"), F.round(F.avg("change"), 6).alias("delta"), F.count_if(better).alias("improved"), F.count_if(worse).alias("regressed"),
        F.round(F.coalesce(F.min(F.when(worse, F.col("change"))), F.lit(0.0)), 6).alias("worst"), F.sort_array(F.collect_list(F.when(worse, F.col("query")))).alias("regressed_queries"),
    )
    return told.withColumn("adopt", (F.col("regressed") == 0) & (F.col("delta") > 0))


def implied_facets(judged: DataFrame, chunks: DataFrame, key: str, names: Sequence[str]) -> DataFrame:
    """(query, a list of one value for each facet) of the best judged item of each query (of equals the smallest): what one who knows the answer would narrow by."""
    best = _grades(judged).groupBy("query").agg(F.max_by("item", "grade").alias("item"))
    return best.join(chunks, best["item"] == chunks[key]).select("query", *[F.array(F.col(c)).alias(c) for c in names])


def faceted(spark: SparkSession, path: str, queries: DataFrame, judged: DataFrame, names: Sequence[str], k: int = 10) -> DataFrame:
    """(query, open, faceted, change): nDCG of a search of everything, and of one narrowed by implied_facets()."""
    from quarry.operators.index import Index

    ix = Index(spark, path)
    facets = staged(implied_facets(judged, ix.chunks(), ix.key, names), "implied-facets")
    wide = golden_scores(spark, path, queries, judged, k).select("query", F.col("ndcg").alias("open"))
    narrow = golden_scores(spark, path, queries, judged, k, facets=facets).select("query", F.col("ndcg").alias("faceted"))
    return wide.join(narrow, "query").withColumn("change", F.round(F.col("faceted") - F.col("open"), 6))


def reached(spark: SparkSession, path: str, questions: DataFrame, answers: DataFrame, k: int = 10) -> DataFrame:
    """questions(subject, form, text), answers(subject, item) -> (subject, form, reached): whether an answer is among the k best, all questions in one pass."""
    named = questions.select(F.struct("subject", "form").alias("query"), "text")
    ranked = search.search_many(spark, path, named, k)
    key = next(c for c in ranked.columns if c not in ("query", "point", "rank", "score"))
    hits = ranked.select("query.subject", "query.form", F.col(key).alias("item")).join(answers, ["subject", "item"], "left_semi").select("subject", "form").distinct()
    return questions.select("subject", "form").distinct().join(hits.withColumn("reached", F.lit(True)), ["subject", "form"], "left").withColumn("reached", F.coalesce("reached", F.lit(False)))


def vocabulary_cost(spark: SparkSession, path: str, files: DataFrame, answers: DataFrame, k: int = 10) -> DataFrame:
    """files(number, name), answers(number, item) -> one row a file that has answers: (number, answers, by_number, by_name, expanded, both).

    What a search misses that knows a file by its number where the answers know it by name: the question by number, by name, by number with
    the phrase that an expansion adds (where number and name can make one), and by both, the most that any expansion can reach."""
    asked = files.join(answers.groupBy("number").agg(F.count("*").alias("answers")), "number")
    number, name = F.col("number").cast("string"), F.trim("name")
    by_number = F.concat(F.lit("what is file "), number, F.lit("?"))
    usable = F.upper(number).rlike("^[A-Z0-9]{3,}$") & (F.size(F.split(name, r"\s+")) >= 2)
    expanded = F.when(usable, F.concat(by_number, F.lit(" "), F.regexp_replace(F.lower(name), r"\s+", "_"))).otherwise(by_number)
    forms = {"by_number": by_number, "by_name": F.concat(F.lit("what is the "), name, F.lit(" file?")), "expanded": expanded, "both": F.concat(by_number, F.lit(" "), name)}
    asked = staged(asked, "vocabulary")
    questions = asked.select(F.col("number").alias("subject"), F.explode(F.array(*[F.struct(F.lit(f).alias("form"), text.alias("text")) for f, text in forms.items()])).alias("q")).select("subject", "q.form", "q.text")
    found = reached(spark, path, questions, answers.withColumnRenamed("number", "subject"), k)
    wide = found.groupBy(F.col("subject").alias("number")).agg(*[F.bool_or((F.col("form") == f) & F.col("reached")).alias(f) for f in forms])
    return asked.select("number", "answers").join(wide, "number")
