"""Driver plans: role mappings onto the supplied tables, the registered queries
and their DuckDB oracle SQL."""
