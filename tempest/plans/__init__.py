"""Registered queries (Spark plans) and their DuckDB oracles."""
