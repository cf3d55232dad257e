"""SQL twins of the registered queries, for DuckDB. Not used by the library."""
