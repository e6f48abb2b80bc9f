"""What a consumer calls: search, lookup, guarded queries and published recipes over views of the corpus."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.operators import search
from quarry.plans import sqlapi

#: Canonical queries over the published views, with named parameters.
RECIPES = {
    "section_text": "SELECT text FROM v_chunks WHERE section_id = :section_id ORDER BY part",
    "filter_documents": "SELECT doc_key, title, kind, app, year FROM v_documents WHERE is_latest AND app = :app AND kind = :kind ORDER BY year DESC, doc_key",
    "entity_lookup": "SELECT entity_id, type, name, mentions FROM v_entities WHERE type = :type AND name LIKE :name ORDER BY mentions DESC, entity_id LIMIT :k",
    "entity_documents": "SELECT DISTINCT m.doc_key, d.title FROM v_mentions m JOIN v_documents d ON d.doc_key = m.doc_key WHERE m.entity_id = :entity_id",
    "synonyms": "SELECT s.surface, s.kind FROM v_nodes n JOIN v_synonyms s ON s.node = n.node WHERE n.name = :name",
    "staleness": "SELECT key, value FROM v_meta",
}
#: Rows of a search and of an entity's documents at most.
MOST_HITS, MOST_DOCUMENTS = 50, 25


def recipe(spark: SparkSession, name: str, /, **args: object) -> DataFrame:
    return sqlapi.guarded(spark, RECIPES[name], args)


class Tools:
    """The tools over an index and published views."""

    def __init__(self, spark: SparkSession, index: str, expansions: Mapping[str, str] | None = None):
        self.spark, self.index, self.expansions = spark, index, dict(expansions or {})

    def search(self, text: str, k: int = 10, facets: Mapping[str, list[str]] | None = None) -> dict:
        """Hits with a citation, best first; a restating parent follows its child."""
        k = max(1, min(int(k), MOST_HITS))
        rows = search.search(self.spark, self.index, text, 3 * k, facets, self.expansions).orderBy("rank").collect()
        hits = [r.asDict() for r in rows]
        if hits and {"section_id", "section_title", "section_path", "body_len"} <= hits[0].keys():
            hits = search.demote_restating_parents(hits)
        return search.envelope(hits[:k])

    def lookup(self, kind: str, key: str) -> dict | None:
        """A document, a section with its document, or an entity with the documents that mention it."""
        views = {"document": ("v_documents", "doc_key"), "section": ("v_sections", "section_id"), "entity": ("v_entities", "entity_id")}
        if kind not in views:
            raise ValueError(f"unknown kind {kind}")
        view, column = views[kind]
        found = self.spark.table(view).where(F.col(column) == key)
        if kind == "section":
            found = found.join(self.spark.table("v_documents"), "doc_key", "left")
        row = found.first()
        if row is None:
            return None
        out = row.asDict()
        if kind == "entity":
            out["documents"] = [r[0] for r in entity_documents(self.spark.table("v_mentions").where(F.col("entity_id") == key)).collect()]
        return out

    def query(self, text: str, max_rows: int = 50, **args: object) -> dict:
        return sqlapi.query(self.spark, text, max_rows, args)

    def orientation(self) -> dict:
        """What there is: views with their columns and sizes, and the recipes."""
        views = sorted(t.name for t in self.spark.catalog.listTables() if t.name.startswith("v_"))
        return {"views": {v: {"columns": self.spark.table(v).columns, "rows": self.spark.table(v).count()} for v in views}, "recipes": dict(RECIPES)}


def entity_documents(mentions: DataFrame, most: int = MOST_DOCUMENTS) -> DataFrame:
    """The first documents, by key, that mention an entity."""
    return mentions.select("doc_key").distinct().orderBy("doc_key").limit(most)
