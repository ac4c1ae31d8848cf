"""Fixture views, the query catalogue and the DuckDB oracle SQL."""
