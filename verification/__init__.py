"""Expected results of the registered queries, as SQL for DuckDB on the given tables."""
