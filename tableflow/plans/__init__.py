"""Registered queries over the generated tables and their DuckDB oracles."""
