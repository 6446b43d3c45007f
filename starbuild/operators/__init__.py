"""Table-level operators: DataFrames in, a DataFrame out, nothing collected but single values."""
