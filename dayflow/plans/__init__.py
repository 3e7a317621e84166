"""Query plans over the driver tables: one function per query, plus oracle SQL."""
