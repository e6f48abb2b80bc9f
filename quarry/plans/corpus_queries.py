"""Queries of the corpus operators over the test tables, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quarry.functions import text as T
from quarry.operators import evaluate, inventory, mining, neardup, relations, search, versions
from quarry.operators.index import SHARD_TOKENS, Index
from quarry.session import scratch, staged, table
from quarry.sources import html, markdown

FIELDS = {"source": 2.5, "lang": 2.0, "text": 1.0}
SEARCH = ["the", "tion", "et", "und", "the"]
RULES = [("build", r"([0-9]+\.[0-9]+\.[0-9]+)\."), ("mail", r"([A-Za-z0-9.]+@[a-z0-9]+)\."), ("acronym", r"(?:^| )([A-Z][A-Z0-9]{2,7})(?: |,|$)")]
STOP = ["THE", "AND", "DE", "LA", "DER"]


def page_links(spark: SparkSession, d: str) -> DataFrame:
    return html.links(table(spark, d, "pages"))


def page_parts(spark: SparkSession, d: str) -> DataFrame:
    return html.parts(table(spark, d, "pages"))


def bodies(spark: SparkSession, d: str) -> DataFrame:
    return markdown.conversation_bodies(table(spark, d, "conversations")).select("doc_key", F.md5("body").alias("digest"), T.word_count("body").alias("words"))


def shredded(spark: SparkSession, d: str) -> DataFrame:
    return markdown.sections(markdown.conversation_bodies(table(spark, d, "conversations")))


def contents(spark: SparkSession, d: str) -> DataFrame:
    return markdown.table_of_contents(shredded(spark, d))


_INDEXES: dict[tuple[str, str], str] = {}


def index(spark: SparkSession, d: str) -> str:
    """The index of the documents, built once for each application and input."""
    at = (spark.sparkContext.applicationId, d)
    if at not in _INDEXES:
        _INDEXES[at] = search.build_index(table(spark, d, "documents"), "doc_id", FIELDS, scratch(spark, "index"), facets=("lang", "source"), shown=("text",))
    return _INDEXES[at]


def bm25_topk(spark: SparkSession, d: str) -> DataFrame:
    return search.search(spark, index(spark, d), " ".join(SEARCH)).select("doc_id", "score")


def bm25_faceted(spark: SparkSession, d: str) -> DataFrame:
    return search.search(spark, index(spark, d), "the tion", facets={"lang": ["en"], "source": ["src1", "src2", "src3"]}).select("doc_id", "score")


def search_hits(spark: SparkSession, d: str) -> DataFrame:
    """Shaped hit rows: rank, score, a citation and the length of the text."""
    hits = search.search(spark, index(spark, d), "und tion", k=15, facets={"lang": ["de", "en"]})
    return hits.select("rank", "doc_id", "score", "lang", "source", F.concat(F.lit("corpus://section/"), "doc_id").alias("uri"), F.length("text").cast("long").alias("body_len"))


def snippets(spark: SparkSession, d: str) -> DataFrame:
    """The 16 words of each hit that hold most query words, these in brackets."""
    hits = search.search(spark, index(spark, d), ["the", "tion"])
    return hits.select("doc_id", search.snippet(F.col("text"), ["the", "tion"]).alias("snippet"))


def phrase_search(spark: SparkSession, d: str) -> DataFrame:
    """Documents by a phrase of two words in a row, as an underscore in a token asks for."""
    return search.search(spark, index(spark, d), "of_the", k=20).select("doc_id", "score")


def index_meta(spark: SparkSession, d: str) -> DataFrame:
    """What the index says of itself, and how many terms and postings it has."""
    path = index(spark, d)
    more = Index(spark, path).words().agg(F.count("*").alias("terms"), F.sum("times").alias("tokens"))
    return spark.read.parquet(f"{path}/meta").select("schema_version", "n", F.round("avgdl", 4).alias("avgdl")).crossJoin(F.broadcast(more))  # one row each


def postings_whole(spark: SparkSession, d: str) -> DataFrame:
    """Every term of all documents: in how many it stands, and its weight."""
    w = F.array(*[F.lit(float(v)) for v in FIELDS.values()])
    ix = Index(spark, index(spark, d))
    found = ix.postings().select("term", "doc_id", F.aggregate("at", F.lit(0.0), lambda n, a: n + F.get(w, a["f"].cast("int"))).alias("f"))
    # As many tasks as the tokens ask for, whatever the session's number.
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), sum(s.tokens for s in ix.segments) // SHARD_TOKENS + 1)
    found = found.repartition(tasks, "term", "doc_id")
    found = found.groupBy("term", "doc_id").agg(F.sum("f").alias("f"))  # an id may have several rows
    return found.groupBy("term").agg(F.count("*").alias("n"), F.round(F.sum("f"), 4).alias("f"))


def exact_groups(spark: SparkSession, d: str) -> DataFrame:
    return neardup.exact_groups(table(spark, d, "documents"))


def shingle_jaccard(spark: SparkSession, d: str) -> DataFrame:
    """Each document with the next of its source and language: ids are put in order, shingle sets are joined by id as hashes."""
    docs = table(spark, d, "documents")
    nxt = F.lead("doc_id").over(Window.partitionBy("source", "lang").orderBy("doc_id"))
    pairs = docs.select("doc_id", nxt.alias("other")).where("other IS NOT NULL")
    sets = staged(docs.select("doc_id", neardup.shingle_set(F.coalesce("text", F.lit(""))).alias("s")), "shingle-sets")
    both = pairs.join(sets, "doc_id").join(sets.select(F.col("doc_id").alias("other"), F.col("s").alias("t")), "other")
    return both.select("doc_id", F.round(neardup.jaccard(F.col("s"), F.col("t")), 6).alias("similarity"))


def _signatures(spark: SparkSession, d: str) -> DataFrame:
    at = (spark.sparkContext.applicationId, d)
    if at not in _SIGNED:
        _SIGNED[at] = staged(neardup.minhash(table(spark, d, "documents")), "signatures")
    return _SIGNED[at]


_SIGNED: dict[tuple[str, str], DataFrame] = {}


def signatures(spark: SparkSession, d: str) -> DataFrame:
    """The signature of every document: first and last permutation, and a digest of all 128."""
    s = F.col("signature")
    return _signatures(spark, d).select("doc_id", s[0].alias("m0"), s[127].alias("m127"), F.md5(F.concat_ws(",", s.cast("array<string>"))).alias("digest"))


def minhash_first(spark: SparkSession, d: str) -> DataFrame:
    """Two permutations of the family by decimal arithmetic over benchmark texts, as a check of the fast path."""
    h = F.transform(neardup.shingles(F.col("text")), neardup.shingle_hash)
    return table(spark, d, "benchmark").select("item_id", neardup.minhash_exact(h, 0).alias("m0"), neardup.minhash_exact(h, 1).alias("m1"))


def near_clusters(spark: SparkSession, d: str) -> DataFrame:
    return neardup.clusters(_signatures(spark, d), "doc_id", 0.8, 128)


def _mentions(spark: SparkSession, d: str) -> DataFrame:
    return relations.mentions(table(spark, d, "documents"), RULES)


def entity_counts(spark: SparkSession, d: str) -> DataFrame:
    return relations.entity_counts(_mentions(spark, d))


def edges(spark: SparkSession, d: str) -> DataFrame:
    return relations.edges(staged(_mentions(spark, d), "mentions"), ["build", "mail"])


def top_entities(spark: SparkSession, d: str) -> DataFrame:
    return relations.top_per_type(entity_counts(spark, d), 5, {"acronym": 3})


def tagged(spark: SparkSession, d: str) -> DataFrame:
    nodes = table(spark, d, "part").select(F.split("p_name", " ")[0].alias("surface"), F.split("p_name", " ")[0].alias("node")).distinct()
    return relations.tag_texts(table(spark, d, "part"), nodes, "p_partkey", "p_name")


def latest(spark: SparkSession, d: str) -> DataFrame:
    return versions.lineage(table(spark, d, "documents").select("doc_id", "source", "lang", "n_chars"), ["source", "lang"], ["n_chars"], "doc_id")


def history(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders")
    old = o.where("o_orderkey % 3 <> 0").select("o_orderkey", F.col("o_orderpriority").alias("body"), F.array(F.lit("older")).alias("superseded"))
    new = o.where("o_orderkey % 4 <> 0").select("o_orderkey", F.when(F.col("o_orderkey") % 5 == 0, F.lit("changed")).otherwise(F.col("o_orderpriority")).alias("body"))
    return versions.merge_history(old, new, "o_orderkey", "body").select("o_orderkey", "body", F.concat_ws("|", "superseded").alias("superseded"))


def delta(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "customer")
    before = c.where("c_custkey % 11 <> 0").select("c_custkey", "c_name", "c_mktsegment")
    after = c.where("c_custkey % 13 <> 0").select("c_custkey", F.when(F.col("c_custkey") % 17 == 0, F.lit("new")).otherwise(F.col("c_name")).alias("c_name"), F.when(F.col("c_custkey") % 9 == 0, F.lit("closed")).otherwise(F.col("c_mktsegment")).alias("c_mktsegment"))
    return versions.snapshot_delta(before, after, "c_custkey", "c_name", "c_mktsegment")


def latest_events(spark: SparkSession, d: str) -> DataFrame:
    return versions.latest_state(table(spark, d, "events"), "user_id", "ts", ["event_id", "event_type"])


def chain(spark: SparkSession, d: str) -> DataFrame:
    docs, pages, labels = (table(spark, d, t) for t in ("documents", "pages", "labels"))
    return versions.reconcile({"documents": docs, "labels": labels, "pages": pages.select(F.col("page_id").alias("doc_id"))}, "doc_id")


def chosen(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").withColumn("anchor", F.concat_ws(":", "source", "lang"))
    picked = inventory.selection(lang=["en", "de", "fr"], source=["src1", "src2", "src3"]) & (F.col("n_chars") > 3000)
    return inventory.with_whole_groups(docs, picked, "anchor", "doc_id").select("doc_id", "anchor")


def admission(spark: SparkSession, d: str) -> DataFrame:
    ok = inventory.admitted(["PROMO", "STANDARD"], "p_type", ["Brand#11", "Brand#22"], "p_brand", ["1", "2", "3"], "size")
    return table(spark, d, "part").withColumn("size", F.col("p_size").cast("string")).select("p_partkey", ok.alias("admitted"))


def survivors(spark: SparkSession, d: str) -> DataFrame:
    return inventory.sole_survivors(table(spark, d, "orders"), F.col("o_orderstatus") == "F", "o_custkey")


def peers(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").withColumn("code", F.when(F.col("doc_id") % 3 == 0, F.lit("")).otherwise(F.concat(F.lit("c"), (F.col("doc_id") % 2).cast("string"))))
    return inventory.inherit_from_peers(docs.withColumn("grp", F.floor(F.col("doc_id") / 3)), "grp", "code").select("doc_id", "inherited")


def dispositions(spark: SparkSession, d: str) -> DataFrame:
    rules = [(F.col("n_chars") < 40, "noise"), (F.col("lang") == "es", "out_of_scope"), (F.col("source") == "src0", "undecided")]
    return table(spark, d, "documents").select(inventory.disposition(rules, "held").alias("status")).groupBy("status").agg(F.count("*").alias("n"))


def facets(spark: SparkSession, d: str) -> DataFrame:
    return inventory.facet_distribution(table(spark, d, "documents"), ["lang", "source"])


def covered(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").join(table(spark, d, "labels"), "doc_id", "left")
    return inventory.coverage(docs, ["lang", "text", "quality"], {"lang": 100.0, "quality": 50.0})


def floors(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents")
    return inventory.crawl_floor(docs, docs.where("(lang = 'en' OR doc_id % 4 = 0) AND lang <> 'es'"), "lang", 0.5)


def dangling(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "labels").join(table(spark, d, "pages").select(F.col("page_id").alias("doc_id")), "doc_id", "left_anti").select("doc_id")


def blocks(spark: SparkSession, d: str) -> DataFrame:
    """Lines of documents as blocks, each parted from the next by a blank line."""
    docs = table(spark, d, "documents").select("doc_id", F.replace("text", F.lit("\n"), F.lit("\n \n")).alias("text"))
    return mining.recurring_blocks(docs).select(F.md5("block").alias("block"), "documents", F.md5("sample").alias("sample"), "first", "shape", "disposition", "grade")


def glossary(spark: SparkSession, d: str) -> DataFrame:
    return mining.glossary(table(spark, d, "documents"), STOP)


def common_roles(spark: SparkSession, d: str) -> DataFrame:
    return mining.most_common(table(spark, d, "events").select("user_id", "event_type"), "user_id", "event_type")


def outline(spark: SparkSession, d: str) -> DataFrame:
    return mining.consensus(shredded(spark, d).where("level = 2"), "doc_key", "title", "level", "seq")


def urls_shared(spark: SparkSession, d: str) -> DataFrame:
    return mining.shared_urls(table(spark, d, "pages").withColumn("host", T.url_host(F.col("url"))), "host").select("page_id", "shared")


def metrics(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.max("l_extendedprice").alias("l_extendedprice"), F.max("l_suppkey").alias("l_suppkey"))
    place = F.row_number().over(Window.partitionBy("l_orderkey").orderBy(F.desc("l_extendedprice"), "l_linenumber"))
    ranked = o.select(F.col("l_orderkey").alias("query"), F.col("l_linenumber").alias("item"), place.alias("rank"))
    judged = o.select(F.col("l_orderkey").alias("query"), F.col("l_linenumber").alias("item"), (F.col("l_suppkey") % 4).cast("int").alias("grade"))
    return evaluate.ranking_metrics(ranked, judged, 3)


def retained(spark: SparkSession, d: str) -> DataFrame:
    before, after = T.word_count(F.col("html")), T.word_count(T.strip_html(F.col("html")))
    return table(spark, d, "pages").select("page_id", evaluate.retention(before, after, F.lit(0)).alias("r")).select("page_id", "r.score", "r.verdict")


def digest(spark: SparkSession, d: str) -> DataFrame:
    return evaluate.content_hash(table(spark, d, "orders"), ["o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority"])


QUERIES = {
    "page_links": page_links, "page_parts": page_parts, "conversation_bodies": bodies, "shred_sections": shredded, "toc_build": contents,
    "search_bm25_topk": bm25_topk, "search_bm25_faceted": bm25_faceted, "search_hits": search_hits, "snippets": snippets, "phrase_search": phrase_search, "index_meta": index_meta, "search_postings_whole": postings_whole, "minhash_signatures": signatures,
    "exact_dup_groups": exact_groups, "shingle_jaccard": shingle_jaccard, "minhash_permutations": minhash_first, "near_dup_clusters": near_clusters,
    "entity_counts": entity_counts, "relation_edges": edges, "top_entities_per_type": top_entities, "tag_texts": tagged,
    "latest_per_group": latest, "history_merge": history, "snapshot_delta": delta, "latest_state": latest_events, "chain_reconcile": chain,
    "select_targets": chosen, "admission": admission, "sole_survivors": survivors, "peer_inference": peers, "completeness_report": dispositions,
    "facet_distribution": facets, "coverage_stats": covered, "crawl_floor": floors, "dangling_labels": dangling,
    "recurring_blocks": blocks, "glossary_acronyms": glossary, "most_common_value": common_roles, "consensus_outline": outline, "shared_hosts": urls_shared,
    "ranking_metrics": metrics, "retention_score": retained, "content_hash": digest,
}

_TOK = r"regexp_extract_all(lower({}), '[\p{{L}}\p{{N}}]+')"


def _bm25(words: list[str], where: str) -> str:
    """SQL of the score of a list of query words, repeats included, in the shape that search.bm25() sums."""
    want = sorted(set(words))
    counts = ", ".join("(" + " + ".join(f"len(list_filter({_TOK.format(c)}, lambda x: x = '{q}')) * {w}" for c, w in FIELDS.items()) + f")::DOUBLE AS f{k}" for k, q in enumerate(want))
    size = " + ".join(f"len({_TOK.format(c)})" for c in FIELDS)
    terms = " + ".join(f"{words.count(q)} * (CASE WHEN ln((n - n{k} + 0.5) / (n{k} + 0.5)) > 0 THEN ln((n - n{k} + 0.5) / (n{k} + 0.5)) ELSE 1e-6 END) * f{k} * 2.2 / (f{k} + 1.2 * (0.25 + 0.75 * d / avgdl))" for k, q in enumerate(want))
    stats = ", ".join(f"count(*) FILTER (f{k} > 0)::DOUBLE AS n{k}" for k in range(len(want)))
    some = " OR ".join(f"f{k} > 0" for k in range(len(want)))
    return f"""WITH s AS (SELECT doc_id, lang, source, {size} AS d, {counts} FROM documents), t AS (SELECT count(*)::DOUBLE AS n, avg(d) AS avgdl, {stats} FROM s),
        r AS (SELECT doc_id, round({terms}, 4) AS score FROM s, t WHERE ({some}) AND {where}) SELECT doc_id, score FROM r ORDER BY score DESC, doc_id LIMIT 10"""


_BODY = "SELECT conv_id AS doc_key, '# Conversation ' || conv_id || chr(10) || string_agg('## ' || role || chr(10) || coalesce(text, ''), chr(10) ORDER BY turn) AS body FROM conversations GROUP BY conv_id"
# A heading stands alone in these bodies, so a section is a turn, and the title section is empty.
_SECTIONS = r"""WITH t AS (SELECT conv_id, turn, role, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS i, row_number() OVER (PARTITION BY conv_id, role ORDER BY turn) - 1 AS nth, len(regexp_extract_all(coalesce(text, ''), '[^ \t\n]+')) AS tokens FROM conversations),
 sec AS (SELECT conv_id AS doc_key, (i + 1)::BIGINT AS seq, 2 AS level, role AS title, 'Conversation ' || conv_id AS path, role || CASE WHEN nth > 0 THEN '-' || nth ELSE '' END AS slug, tokens::BIGINT AS tokens, CASE WHEN tokens >= 8 THEN 'ok' ELSE 'hollow' END AS kind, tokens > 0 AS searchable FROM t
 UNION ALL SELECT DISTINCT conv_id, 1, 1, 'Conversation ' || conv_id, '', 'conversation-' || conv_id, 0, 'container', false FROM conversations)"""
_SHINGLES = r"""CASE WHEN len(w) = 0 THEN [] ELSE list_distinct(list_transform(range(1, greatest(len(w) - 2, 1) + 1), lambda i: array_to_string(w[i:i+2], ' '))) END"""
_MENTIONS = r"""WITH l AS (SELECT doc_id, i - 1 AS section, x[i] AS line FROM (SELECT doc_id, x, unnest(range(1, len(x) + 1)) AS i FROM (SELECT doc_id, string_split(text, chr(10)) AS x FROM documents))),
 m AS (SELECT doc_id, section, 'build' AS type, upper(unnest(regexp_extract_all(line, '([0-9]+\.[0-9]+\.[0-9]+)\.', 1))) AS canonical FROM l
 UNION ALL SELECT doc_id, section, 'mail', upper(unnest(regexp_extract_all(line, '([A-Za-z0-9.]+@[a-z0-9]+)\.', 1))) FROM l
 UNION ALL SELECT doc_id, section, 'acronym', upper(unnest(regexp_extract_all(line, '(?:^| )([A-Z][A-Z0-9]{2,7})(?: |,|$)', 1))) FROM l),
 e AS (SELECT *, type || ':' || canonical AS entity_id FROM m)"""


def _perm(i: int) -> str:
    a, b = neardup.coefficients(i)
    return f"coalesce(list_min(list_transform(h, lambda x: ((x::HUGEINT * {a}::HUGEINT + {b}::HUGEINT) % {neardup.PRIME}::HUGEINT) % 4294967296::HUGEINT))::BIGINT, 4294967295)"


def _stripped(c: str) -> str:
    """SQL of text.strip_html()."""
    out = f"regexp_replace({c}, '<[^>]+>', '', 'g')"
    for name, value in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "''"), ("&nbsp;", " "), ("&copy;", "©"), ("&middot;", "·"), ("&amp;", "&")):
        out = f"replace({out}, '{name}', '{value}')"
    return rf"trim(regexp_replace({out}, '[ \t]+', ' ', 'g'))"


def _words(c: str) -> str:
    return rf"len(regexp_extract_all({c}, '[^ \t\n\r\x0B\f]+'))"


def _tag(tag: str) -> str:
    return _stripped(f"regexp_extract(html, '(?is)<{tag}[^>]*>(.*?)</{tag}>', 1)")


ORACLES = {
    "page_parts": f"SELECT page_id, lower(regexp_extract(url, '^[a-zA-Z]+://([^/?#]+)', 1)) AS host, {_tag('title')} AS title, {_tag('h1')} AS heading, len(regexp_extract_all(html, '(?i)<p>'))::BIGINT AS paragraphs FROM pages",
    "retention_score": f"""WITH w AS (SELECT page_id, {_words('html')} AS a, {_words(_stripped('html'))} AS b FROM pages), s AS (SELECT page_id, CASE WHEN a = 0 THEN 1.0 ELSE least(1.0, b / a) END AS s FROM w)
        SELECT page_id, round(s, 6) AS score, CASE WHEN s >= 0.8 THEN 'PASS' WHEN s >= 0.5 THEN 'REVIEW' ELSE 'QUARANTINE' END AS verdict FROM s""",
    "page_links": """WITH x AS (SELECT page_id, regexp_extract_all(html, '(?i)<a href="([^"]*)">([^<]*)</a>', 1) AS t, regexp_extract_all(html, '(?i)<a href="([^"]*)">([^<]*)</a>', 2) AS l FROM pages),
        y AS (SELECT page_id, i - 1 AS pos, t[i] AS target, l[i] AS label FROM (SELECT *, unnest(range(1, len(t) + 1)) AS i FROM x))
        SELECT page_id, target, min(pos)::BIGINT AS pos, arg_min(label, pos) AS label FROM y GROUP BY page_id, target""",
    "conversation_bodies": rf"SELECT doc_key, md5(body) AS digest, len(regexp_extract_all(body, '[^ \t\n\r\x0B\f]+'))::BIGINT AS words FROM ({_BODY})",
    "shred_sections": f"{_SECTIONS} SELECT * FROM sec",
    "toc_build": f"{_SECTIONS} SELECT doc_key, string_agg('- [' || title || '](#' || slug || ')', chr(10) ORDER BY seq) AS toc FROM sec WHERE level = 2 GROUP BY doc_key",
    "search_bm25_topk": _bm25(SEARCH, "true"),
    "search_bm25_faceted": _bm25(["the", "tion"], "lang = 'en' AND source IN ('src1', 'src2', 'src3')"),
    "search_hits": _bm25(["und", "tion"], "lang IN ('de', 'en')").replace("SELECT doc_id, score FROM r ORDER BY score DESC, doc_id LIMIT 10", """
        SELECT row_number() OVER (ORDER BY score DESC, doc_id) AS rank, doc_id, score, lang, source, 'corpus://section/' || doc_id AS uri, length(text)::BIGINT AS body_len FROM r JOIN documents USING (doc_id) ORDER BY score DESC, doc_id LIMIT 15"""),
    "phrase_search": """WITH t AS (SELECT doc_id, regexp_extract_all(lower(text), '[\\p{L}\\p{N}]+') AS w, len(regexp_extract_all(lower(source), '[\\p{L}\\p{N}]+')) + len(regexp_extract_all(lower(lang), '[\\p{L}\\p{N}]+')) AS more FROM documents),
        c AS (SELECT doc_id, len(w) + more AS d, len(list_filter(range(1, len(w)), lambda i: w[i] = 'of' AND w[i + 1] = 'the'))::DOUBLE AS f FROM t), s AS (SELECT count(*)::DOUBLE AS n, avg(d) AS avgdl, count(*) FILTER (f > 0)::DOUBLE AS p FROM c)
        SELECT doc_id, round((CASE WHEN ln((n - p + 0.5) / (p + 0.5)) > 0 THEN ln((n - p + 0.5) / (p + 0.5)) ELSE 1e-6 END) * f * 2.2 / (f + 1.2 * (0.25 + 0.75 * d / avgdl)), 4) AS score FROM c, s WHERE f > 0 ORDER BY score DESC, doc_id LIMIT 20""",
    "index_meta": "WITH t AS (SELECT doc_id, " + " || ".join(_TOK.format(f"coalesce({c}, '')") for c in FIELDS) + " AS w FROM documents) SELECT '1' AS schema_version, count(*) AS n, round(avg(len(w)), 4) AS avgdl, (SELECT count(DISTINCT x) FROM (SELECT unnest(w) AS x FROM t)) AS terms, sum(len(w))::BIGINT AS tokens FROM t",
    "exact_dup_groups": "SELECT sha256(text) AS digest, min(doc_id) AS first, count(*) AS n FROM documents GROUP BY text HAVING count(*) > 1",
    "shingle_jaccard": rf"""WITH n AS (SELECT doc_id, text, lead(text) OVER (PARTITION BY source, lang ORDER BY doc_id) AS other FROM documents),
        s AS (SELECT doc_id, (SELECT {_SHINGLES} FROM (SELECT regexp_extract_all(lower(text), '[\p{{L}}\p{{N}}_]+') AS w)) AS a, (SELECT {_SHINGLES} FROM (SELECT regexp_extract_all(lower(other), '[\p{{L}}\p{{N}}_]+') AS w)) AS b FROM n WHERE other IS NOT NULL)
        SELECT doc_id, round(CASE WHEN len(list_distinct(a || b)) = 0 THEN 0 ELSE len(list_intersect(a, b)) / len(list_distinct(a || b)) END, 6) AS similarity FROM s""",
    "minhash_permutations": rf"""WITH s AS (SELECT item_id, {_SHINGLES} AS s FROM (SELECT item_id, regexp_extract_all(lower(text), '[\p{{L}}\p{{N}}_]+') AS w FROM benchmark)),
        h AS (SELECT item_id, list_transform(s, lambda x: ('0x' || substr(sha1(x), 1, 16))::UBIGINT) AS h FROM s) SELECT item_id, {_perm(0)} AS m0, {_perm(1)} AS m1 FROM h""",
    "entity_counts": f"{_MENTIONS} SELECT entity_id, type, count(*) AS mentions, count(DISTINCT doc_id) AS documents FROM e GROUP BY entity_id, type",
    "relation_edges": f"""{_MENTIONS}, s AS (SELECT DISTINCT doc_id, section, entity_id FROM e), g AS (SELECT DISTINCT doc_id, entity_id FROM e WHERE type IN ('build', 'mail'))
        SELECT doc_id::VARCHAR AS src, 'mentions' AS rel, entity_id AS dst, count(*) AS weight FROM e GROUP BY doc_id, entity_id
        UNION ALL SELECT a.entity_id, 'cooccurs', b.entity_id, count(*) FROM s a JOIN s b ON a.doc_id = b.doc_id AND a.section = b.section AND a.entity_id < b.entity_id GROUP BY a.entity_id, b.entity_id
        UNION ALL SELECT a.doc_id::VARCHAR, 'xref', b.doc_id::VARCHAR, count(*) FROM g a JOIN g b ON a.entity_id = b.entity_id AND a.doc_id < b.doc_id GROUP BY a.doc_id, b.doc_id""",
    "top_entities_per_type": f"""{_MENTIONS}, c AS (SELECT entity_id, type, count(*) AS mentions, count(DISTINCT doc_id) AS documents FROM e GROUP BY entity_id, type),
        r AS (SELECT *, row_number() OVER (PARTITION BY type ORDER BY mentions DESC, entity_id) AS rank FROM c) SELECT * FROM r WHERE rank <= CASE WHEN type = 'acronym' THEN 3 ELSE 5 END""",
    "tag_texts": r"""WITH w AS (SELECT p_partkey, regexp_extract_all(upper(p_name), '[\p{L}\p{N}]+') AS w FROM part), g AS (SELECT DISTINCT p_partkey, array_to_string(w[i:i+n-1], ' ') AS s FROM (SELECT *, unnest(range(1, len(w) - n + 2)) AS i FROM w, range(1, 4) r(n) WHERE len(w) >= n)),
        n AS (SELECT DISTINCT split_part(p_name, ' ', 1) AS node FROM part) SELECT DISTINCT p_partkey, node FROM g JOIN n ON upper(node) = s""",
    "latest_per_group": "SELECT doc_id, source, lang, n_chars, row_number() OVER (PARTITION BY source, lang ORDER BY n_chars NULLS FIRST, doc_id) AS rank, row_number() OVER (PARTITION BY source, lang ORDER BY n_chars DESC NULLS LAST, doc_id DESC) = 1 AS is_latest FROM documents",
    "history_merge": """WITH e AS (SELECT o_orderkey, o_orderpriority AS old FROM orders WHERE o_orderkey % 3 <> 0), f AS (SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 0 THEN 'changed' ELSE o_orderpriority END AS new FROM orders WHERE o_orderkey % 4 <> 0)
        SELECT o_orderkey, coalesce(new, old) AS body, CASE WHEN old IS NULL THEN '' WHEN new <> old THEN 'older|' || old ELSE 'older' END AS superseded FROM e FULL JOIN f USING (o_orderkey)""",
    "snapshot_delta": """WITH b AS (SELECT c_custkey, c_name AS n0, c_mktsegment AS s0 FROM customer WHERE c_custkey % 11 <> 0), a AS (SELECT c_custkey, CASE WHEN c_custkey % 17 = 0 THEN 'new' ELSE c_name END AS n1, CASE WHEN c_custkey % 9 = 0 THEN 'closed' ELSE c_mktsegment END AS s1 FROM customer WHERE c_custkey % 13 <> 0),
        j AS (SELECT c_custkey, n0, s0, n1, s1, n0 IS NOT NULL AS was, n1 IS NOT NULL AS now FROM b FULL JOIN a USING (c_custkey)), t AS (SELECT count(*) FILTER (was AND now AND s0 <> s1) AS m, count(*) FILTER (was AND now) AS c FROM j)
        SELECT c_custkey, 'arrived' AS change FROM j WHERE NOT was UNION ALL SELECT c_custkey, 'departed' FROM j WHERE NOT now UNION ALL SELECT c_custkey, 'renamed' FROM j WHERE was AND now AND n0 <> n1
        UNION ALL SELECT c_custkey, CASE WHEN m >= 10 AND m > 0.05 * c THEN 'suspect' ELSE 'moved' END FROM j, t WHERE was AND now AND s0 <> s1""",
    "latest_state": "SELECT user_id, ts, event_id, event_type FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC, event_type DESC) AS r FROM events) WHERE r = 1",
    "chain_reconcile": """SELECT 'documents-labels' AS finding, doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels) UNION ALL SELECT 'labels-documents', doc_id FROM (SELECT DISTINCT doc_id FROM labels) WHERE doc_id NOT IN (SELECT doc_id FROM documents)
        UNION ALL SELECT DISTINCT 'labels-pages', doc_id FROM labels WHERE doc_id NOT IN (SELECT page_id FROM pages) UNION ALL SELECT 'pages-labels', page_id FROM pages WHERE page_id NOT IN (SELECT doc_id FROM labels)""",
    "select_targets": "WITH d AS (SELECT *, source || ':' || lang AS anchor FROM documents) SELECT doc_id, anchor FROM d WHERE anchor IN (SELECT anchor FROM d WHERE lang IN ('en', 'de', 'fr') AND source IN ('src1', 'src2', 'src3') AND n_chars > 3000)",
    "admission": "SELECT p_partkey, (starts_with(p_type, 'PROMO') OR starts_with(p_type, 'STANDARD')) AND p_brand NOT IN ('Brand#11', 'Brand#22') AND p_size NOT IN (1, 2, 3) AS admitted FROM part",
    "sole_survivors": "SELECT DISTINCT o_custkey FROM orders WHERE o_orderstatus = 'F' AND o_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus <> 'F')",
    "peer_inference": """WITH d AS (SELECT doc_id, floor(doc_id / 3) AS g, CASE WHEN doc_id % 3 = 0 THEN NULL ELSE 'c' || (doc_id % 2) END AS code FROM documents)
        SELECT doc_id, coalesce(code, CASE WHEN min(code) OVER (PARTITION BY g) = max(code) OVER (PARTITION BY g) THEN min(code) OVER (PARTITION BY g) END) AS inherited FROM d""",
    "completeness_report": "SELECT CASE WHEN n_chars < 40 THEN 'noise' WHEN lang = 'es' THEN 'out_of_scope' WHEN source = 'src0' THEN 'undecided' ELSE 'held' END AS status, count(*) AS n FROM documents GROUP BY 1",
    "facet_distribution": "SELECT 'lang' AS facet, lang AS value, count(*) AS n FROM documents WHERE lang <> '' GROUP BY lang UNION ALL SELECT 'source', source, count(*) FROM documents WHERE source <> '' GROUP BY source",
    "coverage_stats": """WITH d AS (SELECT lang, text, quality::VARCHAR AS quality FROM documents LEFT JOIN labels USING (doc_id)), c AS (SELECT 'lang' AS field, count(nullif(lang, '')) AS populated, count(*) AS total, 100.0 AS f FROM d UNION ALL SELECT 'text', count(nullif(text, '')), count(*), 0 FROM d UNION ALL SELECT 'quality', count(nullif(quality, '')), count(*), 50 FROM d)
        SELECT field, populated, total, round(populated / total * 100, 4) AS pct, CASE WHEN populated / total * 100 >= f THEN 'PASS' ELSE 'FAIL' END AS health FROM c""",
    "crawl_floor": """WITH b AS (SELECT lang, count(*) AS before, count(*) FILTER ((lang = 'en' OR doc_id % 4 = 0) AND lang <> 'es') AS after FROM documents GROUP BY lang) SELECT *, CASE WHEN after = 0 THEN 'dark' WHEN after < 0.5 * before THEN 'low' ELSE 'ok' END AS verdict FROM b""",
    "dangling_labels": "SELECT doc_id FROM labels WHERE doc_id NOT IN (SELECT page_id FROM pages)",
    "recurring_blocks": r"""WITH l AS (SELECT doc_id, i AS pos, regexp_replace(x[i], '^[ \t\n\r\x0B\f]+|[ \t\n\r\x0B\f]+$', '', 'g') AS line FROM (SELECT doc_id, x, unnest(range(1, len(x) + 1)) AS i FROM (SELECT doc_id, string_split(text, chr(10)) AS x FROM documents))),
        k AS (SELECT *, trim(regexp_replace(lower(line), '[ \t\n\r\x0B\f]+', ' ', 'g')) AS block FROM l WHERE line <> ''), g AS (SELECT block, count(DISTINCT doc_id) AS documents, arg_min(line, (doc_id, pos)) AS sample, min(doc_id) AS first FROM k GROUP BY block HAVING count(DISTINCT doc_id) >= 3),
        s AS (SELECT *, CASE WHEN regexp_matches(sample, '^#+ ') THEN 'template' WHEN length(sample) <= 60 THEN 'phrase' ELSE 'boilerplate' END AS shape FROM g)
        SELECT md5(block) AS block, documents, md5(sample) AS sample, first, shape, CASE shape WHEN 'template' THEN 'retain' WHEN 'phrase' THEN 'delete' ELSE 'reference' END AS disposition, CASE WHEN documents >= 10 AND shape <> 'phrase' THEN 'auto' ELSE 'review' END AS grade FROM s""",
    "glossary_acronyms": r"""SELECT term, count(DISTINCT doc_id) AS documents FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[\p{L}\p{N}_]+')) AS term FROM documents) WHERE regexp_full_match(term, '[A-Z][A-Z0-9]{1,7}') AND term NOT IN ('THE', 'AND', 'DE', 'LA', 'DER') GROUP BY term HAVING count(DISTINCT doc_id) >= 3""",
    "most_common_value": "SELECT user_id, event_type, n FROM (SELECT user_id, event_type, count(*) AS n, row_number() OVER (PARTITION BY user_id ORDER BY count(*) DESC, event_type DESC) AS r FROM events GROUP BY user_id, event_type) WHERE r = 1",
    "consensus_outline": f"""{_SECTIONS}, p AS (SELECT title, doc_key, count(*) AS times, min(seq) AS pos, min(level) AS level FROM sec WHERE level = 2 GROUP BY title, doc_key), n AS (SELECT count(DISTINCT doc_key) AS total FROM p)
        SELECT title, count(*) AS members, round(avg(pos), 6) AS position, min(level) AS level, max(times > 1) AS repeats, count(*) >= any_value(total) * 0.5 AS required FROM p, n GROUP BY title HAVING count(*) >= greatest(2, ceil(any_value(total) * 0.25))""",
    "shared_hosts": "SELECT page_id, count(*) OVER (PARTITION BY lower(regexp_extract(url, '^[a-zA-Z]+://([^/?#]+)', 1))) > 1 AS shared FROM pages",
    "ranking_metrics": """WITH r AS (SELECT l_orderkey AS query, l_linenumber AS item, l_suppkey % 4 AS grade, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_extendedprice DESC, l_linenumber) AS rank FROM (SELECT l_orderkey, l_linenumber, max(l_extendedprice) AS l_extendedprice, max(l_suppkey) AS l_suppkey FROM lineitem GROUP BY ALL)),
        i AS (SELECT *, row_number() OVER (PARTITION BY query ORDER BY grade DESC, item) AS place FROM r WHERE grade > 0),
        s AS (SELECT query, sum((pow(2, grade) - 1) / log2(place + 1)) FILTER (place <= 3) AS idcg, sum((pow(2, grade) - 1) / log2(rank + 1)) FILTER (rank <= 3) AS dcg, min(rank) FILTER (rank <= 3) AS first, count(*) FILTER (rank <= 3) AS found, count(*) AS relevant FROM i GROUP BY query)
        SELECT query, round(coalesce(dcg / idcg, 0), 6) AS ndcg, round(coalesce(1 / first, 0), 6) AS rr, round(found / relevant, 6) AS recall FROM s""",
}
