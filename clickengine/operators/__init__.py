"""Batch operators.  Each takes DataFrames plus column names and returns a
DataFrame; the same column logic backs the streaming forms."""
