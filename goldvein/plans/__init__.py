"""Composite jobs (bronze, silver, gold, governance, daily run) and the
catalogue of registered queries with their DuckDB oracle SQL."""
