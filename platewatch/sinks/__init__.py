"""Where results go: relational tables, Parquet tables and message topics."""
