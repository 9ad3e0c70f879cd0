"""DataFrame operators: each is a pure function of DataFrames and parameters."""
