"""Named query plans over the test tables and their DuckDB oracle SQL."""
