"""All queries of the engine itself, by name, and their SQL."""

from __future__ import annotations

from tendril.plans import feature_queries, page_queries, report_queries, sink_queries, text_queries

MODULES = (feature_queries, text_queries, report_queries, page_queries, sink_queries)
QUERIES = {name: q for m in MODULES for name, q in m.QUERIES.items()}
SQL = {name: q for m in MODULES for name, q in m.SQL.items()}
