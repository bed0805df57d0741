"""Query plans over the given tables: fixture mapping, registered queries
(Spark side) and their DuckDB oracle SQL."""
