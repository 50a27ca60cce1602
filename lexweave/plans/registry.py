"""All queries of the library by name, and their SQL."""

from __future__ import annotations

from lexweave.plans import catalog_queries, file_queries, link_queries, serve_queries, text_queries

QUERIES = text_queries.QUERIES | link_queries.QUERIES | serve_queries.QUERIES | catalog_queries.QUERIES | file_queries.QUERIES
SQL = text_queries.SQL | link_queries.SQL | serve_queries.SQL | catalog_queries.SQL | file_queries.SQL
