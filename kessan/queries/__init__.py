"""Registered checks: every operator over the given tables, with the same result in SQL."""

from kessan.queries.registry import all_queries, all_sql  # noqa: F401
