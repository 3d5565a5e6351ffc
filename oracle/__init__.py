"""Independent SQL (DuckDB dialect) definitions used as the correctness oracle."""
