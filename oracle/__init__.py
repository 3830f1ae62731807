"""DuckDB statements used as the independent correctness oracle."""
