"""Test fixtures, the registered query catalog and its DuckDB oracle."""
