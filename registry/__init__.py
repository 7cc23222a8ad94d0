"""Registered queries with their DuckDB statements."""
