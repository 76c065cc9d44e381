"""Registered queries by name, and the SQL that states each one's result."""

from __future__ import annotations

from tidemark.plans import feature_queries, state_queries, window_queries

QUERIES: dict = {**window_queries.QUERIES, **feature_queries.QUERIES, **state_queries.QUERIES}
SQL: dict = {**window_queries.SQL, **feature_queries.SQL, **state_queries.SQL}
