"""Composed jobs, the registered query catalogue and the DuckDB oracle SQL."""
