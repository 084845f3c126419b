"""DuckDB oracle SQL for the registered queries (test-side, not library code)."""
