"""All registered queries of the library, without those of the llm subpackage."""

from __future__ import annotations

from quarry.plans import body_queries, check_queries, corpus_queries, library_queries, office_queries, search_queries, sql_queries, store_queries, template_queries, text_queries

_PARTS = (text_queries, corpus_queries, library_queries, sql_queries, body_queries, check_queries, template_queries, search_queries, office_queries, store_queries)
QUERIES: dict = {k: v for part in _PARTS for k, v in part.QUERIES.items()}
ORACLES: dict = {k: v for part in _PARTS for k, v in part.ORACLES.items()}
