"""Registered queries over the driver tables (Spark plans + DuckDB oracles)."""
