"""Query registry: Spark callables and their DuckDB oracle SQL."""
