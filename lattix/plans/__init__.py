"""Queries over the driver's tables, with their SQL."""

from lattix.plans import catalog_queries, export_queries, ingest_queries, match_queries, project_queries, scalar_queries, vector_queries, write_queries
from lattix.plans.registry import ORACLE_SQL, QUERIES

__all__ = ["ORACLE_SQL", "QUERIES", "catalog_queries", "export_queries", "ingest_queries", "match_queries", "project_queries", "scalar_queries", "vector_queries", "write_queries"]
