"""Query registry (Spark plans) and their DuckDB oracle SQL."""
