"""Table-level building blocks. Each takes DataFrames and returns a DataFrame, with no action inside."""
