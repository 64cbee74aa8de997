"""Query plans: serving (dashboard) queries, documented extras, the registry
of named queries and their DuckDB oracles."""
