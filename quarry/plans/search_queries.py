"""Queries of many searches at once and of an index that is extended, over the test tables, with their SQL."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.operators import evaluate, search
from quarry.operators import index as indexes
from quarry.plans import corpus_queries
from quarry.plans.corpus_queries import FIELDS
from quarry.plans.register import registry
from quarry.session import scratch, table

QUERIES, ORACLES, query = registry()

#: The first point is the shipped one.
GRID = [FIELDS, *({"source": a, "lang": b, "text": 1.0} for a in (0.0, 1.0, 4.0) for b in (0.5, 3.0))]


def _queries(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "benchmark").select(F.col("item_id").alias("query"), F.concat(F.col("text"), F.lit(" src1 en of_the")).alias("text"))


def _judged(spark: SparkSession, d: str) -> DataFrame:
    """Labelled documents are judged for the items whose number ends like theirs, better ones higher."""
    items = table(spark, d, "benchmark").select(F.col("item_id").alias("query"), (F.col("item_id") % 40).alias("m"))
    labels = table(spark, d, "labels").select(F.col("doc_id").alias("item"), (F.col("doc_id") % 40).alias("m"), (1 + F.col("quality")).alias("grade"))
    return items.join(labels, "m").select("query", "item", "grade")


_WORDS = r"regexp_extract_all(lower(coalesce({}, '')), '[\p{{L}}\p{{N}}]+')"


def _many(queries: str, docs: str, fields: Sequence[str], points: Sequence[Mapping[str, float]]) -> str:
    """SQL of the scores of many queries(query, text) over docs(doc_id and fields) at all points: tokens of queries with their repeats, occurrences of
    tokens and of phrases of two by field, and sums by query, point and document; ends with a comma."""
    column = lambda f: f"{f} AS {f}"
    return f"""
WITH point AS (SELECT * FROM (VALUES {", ".join(f"({n}, {', '.join(str(float(g[f])) for f in fields)})" for n, g in enumerate(points))}) t(point, {", ".join(f"w_{f}" for f in fields)})),
unit AS (SELECT query, u AS unit, count(*) AS times FROM (SELECT query, unnest(list_filter(list_transform(regexp_extract_all(text, '[A-Za-z0-9_]+'), lambda t: lower(t)), lambda t: length(t) >= 2 AND regexp_matches(t, '[a-z0-9]'))) AS u FROM ({queries})) GROUP BY ALL),
w AS MATERIALIZED (SELECT doc_id, {", ".join(f"{_WORDS.format(f)} AS {f}" for f in fields)} FROM ({docs})),
tok AS MATERIALIZED ({" UNION ALL ".join(f"SELECT doc_id, '{f}' AS field, {f}[i] AS term, {f}[i+1] AS follows, {f}[i+2] AS third FROM (SELECT doc_id, {column(f)}, unnest(range(1, len({f}) + 1)) AS i FROM w)" for f in fields)}),
occ AS (SELECT doc_id, field, term AS unit FROM tok WHERE term IN (SELECT unit FROM unit) UNION ALL SELECT doc_id, field, term || '_' || follows FROM tok WHERE term || '_' || follows IN (SELECT unit FROM unit)
  UNION ALL SELECT doc_id, field, term || '_' || follows || '_' || third FROM tok WHERE term || '_' || follows || '_' || third IN (SELECT unit FROM unit)),
tf AS MATERIALIZED (SELECT unit, doc_id, {", ".join(f"count(*) FILTER (field = '{f}') AS {f}" for f in fields)} FROM occ GROUP BY ALL),
total AS (SELECT count(*)::DOUBLE AS n, avg({" + ".join(f"len({f})" for f in fields)}) AS avgdl FROM w),
idf AS (SELECT unit, CASE WHEN (n - m + 0.5) / (m + 0.5) > 1 THEN ln((n - m + 0.5) / (m + 0.5)) ELSE 1e-6 END AS rare FROM (SELECT unit, count(*) AS m FROM tf GROUP BY unit), total),
size AS (SELECT doc_id, {" + ".join(f"len({f})" for f in fields)} AS d FROM w),
part AS (SELECT query, point, unit, doc_id, times * rare AS r, {" + ".join(f"w_{f} * {f}" for f in fields)} AS f FROM unit JOIN tf USING (unit) JOIN idf USING (unit), point),
score AS (SELECT query, point, doc_id, round(sum(r * f * 2.2 / (f + 1.2 * (0.25 + 0.75 * d / avgdl)) ORDER BY unit), 4) AS score FROM part JOIN size USING (doc_id), total WHERE f > 0 GROUP BY ALL),
"""


_MANY = _many("SELECT item_id AS query, text || ' src1 en of_the' AS text FROM benchmark", "SELECT doc_id, source, lang, text FROM documents", list(FIELDS), GRID)
_JUDGED = """judged AS (SELECT item_id AS query, doc_id AS item, 1 + quality AS grade FROM benchmark JOIN labels ON item_id % 40 = doc_id % 40),
ideal AS (SELECT query, sum(CASE WHEN place <= 10 THEN (2 ** grade - 1) / log2(place + 1) END) AS idcg FROM (SELECT query, grade, row_number() OVER (PARTITION BY query ORDER BY grade DESC, item) AS place FROM judged) GROUP BY query),
"""


@query(_MANY + "best AS (SELECT *, row_number() OVER (PARTITION BY query, point ORDER BY score DESC, doc_id) AS rank FROM score) SELECT query, point, rank, doc_id, score FROM best WHERE rank <= 10")
def search_many(spark: SparkSession, d: str) -> DataFrame:
    """Every benchmark item as a query, with a facet-like word and a phrase, under all points of the grid."""
    return search.search_many(spark, corpus_queries.index(spark, d), _queries(spark, d), grid=GRID)


@query(_MANY + _JUDGED + """best AS (SELECT *, row_number() OVER (PARTITION BY query, point ORDER BY score DESC, doc_id) AS rank FROM score),
dcg AS (SELECT b.query, point, sum((2 ** grade - 1) / log2(rank + 1)) AS dcg FROM best b JOIN judged j ON j.query = b.query AND j.item = b.doc_id WHERE rank <= 10 GROUP BY ALL),
q AS (SELECT i.query, p.point, round(coalesce(dcg / idcg, 0), 6) AS ndcg FROM ideal i CROSS JOIN (SELECT point FROM point) p LEFT JOIN dcg ON dcg.query = i.query AND dcg.point = p.point),
c AS (SELECT q.point, q.ndcg, q.ndcg - s.ndcg AS change FROM q JOIN q s ON s.query = q.query AND s.point = 0)
SELECT point, round(avg(ndcg), 6) AS ndcg, round(avg(change), 6) AS delta, count(*) FILTER (change > 1e-9) AS improved, count(*) FILTER (change < -1e-9) AS regressed, round(coalesce(min(change) FILTER (change < -1e-9), 0), 6) AS worst, count(*) FILTER (change < -1e-9) = 0 AND round(avg(change), 6) > 0 AS adopt FROM c GROUP BY point""")
def weight_sweep(spark: SparkSession, d: str) -> DataFrame:
    """What each point of the grid would change against the shipped weights."""
    return evaluate.sweep(spark, corpus_queries.index(spark, d), _queries(spark, d), _judged(spark, d), GRID).drop("regressed_queries")


@query(_MANY + _JUDGED + """top AS (SELECT query, item FROM (SELECT query, item, row_number() OVER (PARTITION BY query ORDER BY grade DESC NULLS LAST, item) AS r FROM judged WHERE grade > 0) WHERE r = 1),
facet AS (SELECT query, lang, source FROM top JOIN documents ON doc_id = item),
one AS (SELECT s.query, s.doc_id, score, row_number() OVER (PARTITION BY s.query ORDER BY score DESC, s.doc_id) AS rank FROM score s WHERE point = 0),
two AS (SELECT s.query, s.doc_id, score, row_number() OVER (PARTITION BY s.query ORDER BY score DESC, s.doc_id) AS rank FROM score s JOIN documents x USING (doc_id) JOIN facet f ON f.query = s.query AND f.lang = x.lang WHERE point = 0),
o AS (SELECT b.query, sum((2 ** grade - 1) / log2(rank + 1)) AS dcg FROM one b JOIN judged j ON j.query = b.query AND j.item = b.doc_id WHERE rank <= 10 GROUP BY b.query),
n AS (SELECT b.query, sum((2 ** grade - 1) / log2(rank + 1)) AS dcg FROM two b JOIN judged j ON j.query = b.query AND j.item = b.doc_id WHERE rank <= 10 GROUP BY b.query),
r AS (SELECT i.query, round(coalesce(o.dcg / idcg, 0), 6) AS open, round(coalesce(n.dcg / idcg, 0), 6) AS faceted FROM ideal i LEFT JOIN o ON o.query = i.query LEFT JOIN n ON n.query = i.query)
SELECT query, open, faceted, round(faceted - open, 6) AS change FROM r""")
def faceted_evaluation(spark: SparkSession, d: str) -> DataFrame:
    """What narrowing by the language of the best judged document gains."""
    return evaluate.faceted(spark, corpus_queries.index(spark, d), _queries(spark, d), _judged(spark, d), ["lang"])


_CUT = "doc_id % 100 = 7"


@query("""WITH t AS (SELECT doc_id, lang, source, CASE WHEN doc_id % 100 = 8 THEN 'tion ' || coalesce(text, '') ELSE text END AS text FROM documents WHERE doc_id % 100 <> 9)""" + ", " + corpus_queries._bm25(corpus_queries.SEARCH, "true")[5:].replace("FROM documents)", "FROM t)", 1).replace("t AS (SELECT count(*)::DOUBLE", "u AS (SELECT count(*)::DOUBLE").replace("FROM s, t WHERE", "FROM s, u WHERE"))
def search_extended(spark: SparkSession, d: str) -> DataFrame:
    """Search of an index that was built without some documents, then brought to the table: some new, some changed, some gone; then merged."""
    docs = table(spark, d, "documents").select("doc_id", "lang", "source", "text")
    home = scratch(spark, "extended")
    indexes.build(docs.where(f"NOT {_CUT}"), "doc_id", FIELDS, home, facets=("lang", "source"))
    now = docs.where("doc_id % 100 <> 9").withColumn("text", F.when(F.col("doc_id") % 100 == 8, F.concat(F.lit("tion "), F.coalesce("text", F.lit("")))).otherwise(F.col("text")))
    indexes.update(now, home)
    path = indexes.merge(spark, home, whole=True)
    return search.search(spark, path, " ".join(corpus_queries.SEARCH)).select("doc_id", "score")


_FILES = "SELECT n_nationkey + 100 AS number, n_name || ' register' AS name FROM nation"
_QUESTIONS = f"""SELECT number || '|' || form AS query, CASE form WHEN 'by_name' THEN 'what is the ' || name || ' file?' ELSE 'what is file ' || number || '?' || CASE form WHEN 'both' THEN ' ' || name WHEN 'expanded' THEN ' ' || replace(lower(name), ' ', '_') ELSE '' END END AS text
FROM ({_FILES}), (VALUES ('by_number'), ('by_name'), ('expanded'), ('both')) f(form)"""
_CARDS = "SELECT s_suppkey AS doc_id, CASE WHEN s_suppkey % 2 = 0 THEN 'file ' || (n_nationkey + 100) || ' is closed' ELSE 'the ' || n_name || ' register is a file' END AS body FROM supplier JOIN nation ON s_nationkey = n_nationkey"


@query(_many(_QUESTIONS, _CARDS, ["body"], [{"body": 1.0}]) + f"""best AS (SELECT query, doc_id, row_number() OVER (PARTITION BY query ORDER BY score DESC, doc_id) AS rank FROM score),
answer AS (SELECT n_nationkey + 100 AS number, s_suppkey AS item FROM supplier JOIN nation ON s_nationkey = n_nationkey WHERE s_suppkey % 2 = 1),
hit AS (SELECT DISTINCT query FROM best JOIN answer ON doc_id = item AND string_split(query, '|')[1] = number::VARCHAR WHERE rank <= 10)
SELECT number::BIGINT AS number, count(*) AS answers, {", ".join(f"number || '|{f}' IN (SELECT query FROM hit) AS {f}" for f in ("by_number", "by_name", "expanded", "both"))} FROM answer GROUP BY number""")
def vocabulary_cost(spark: SparkSession, d: str) -> DataFrame:
    """Registers asked for by number, by name or by both, where every other supplier's card gives only the name."""
    nations = table(spark, d, "nation").select(F.col("n_nationkey").alias("s_nationkey"), (F.col("n_nationkey") + 100).cast("long").alias("number"), "n_name")
    cards = table(spark, d, "supplier").join(nations, "s_nationkey").select(F.col("s_suppkey").alias("item"), "number", "n_name")
    body = F.when(F.col("item") % 2 == 0, F.concat(F.lit("file "), "number", F.lit(" is closed"))).otherwise(F.concat(F.lit("the "), "n_name", F.lit(" register is a file")))
    path = indexes.build(cards.select("item", body.alias("body")), "item", {"body": 1.0}, scratch(spark, "cards"))
    files = nations.select("number", F.concat("n_name", F.lit(" register")).alias("name"))
    return evaluate.vocabulary_cost(spark, path, files, cards.where("item % 2 = 1").select("number", "item"))
