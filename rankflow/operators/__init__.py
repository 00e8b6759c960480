"""DataFrame operators. Each takes and returns DataFrames and never collects data."""
