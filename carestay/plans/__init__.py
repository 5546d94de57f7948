"""Shared plan shapes: size-checked broadcast joins, distributed running totals, and the
registry of named queries with their DuckDB oracles."""
