"""Registered queries, their fixture views and their DuckDB counterparts."""
