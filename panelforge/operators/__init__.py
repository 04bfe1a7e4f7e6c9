"""DataFrame operators (transform DataFrames, never collect them)."""
