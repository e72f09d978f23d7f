"""All named queries of the core with their SQL."""

from __future__ import annotations

from tessera.plans import analysis_queries, catalog_queries, coverage_queries, hierarchy_queries, inventory_queries, lane_queries, page_queries, record_queries, relational_queries, trace_queries

_MODULES = (hierarchy_queries, inventory_queries, relational_queries, analysis_queries, coverage_queries, lane_queries, catalog_queries, record_queries, page_queries, trace_queries)

QUERIES = {k: v for m in _MODULES for k, v in m.QUERIES.items()}
ORACLE = {k: v for m in _MODULES for k, v in m.ORACLE.items()}
FLAGSHIP = "search_documents"
