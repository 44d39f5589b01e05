"""Role views over the given tables, and the registry of queries with their SQL."""
