"""All queries of the core, and the SQL that states the same for a second engine."""

from __future__ import annotations

from factloom.plans import document_queries, fact_queries, filing_queries, graph_queries, problems, text_queries

_PARTS = [problems, text_queries, fact_queries, graph_queries, document_queries, filing_queries]
QUERIES = {name: query for part in _PARTS for name, query in part.QUERIES.items()}
ORACLES = {name: sql for part in _PARTS for name, sql in part.ORACLES.items()}
