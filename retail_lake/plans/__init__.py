"""Layer models: each is a pure function of DataFrames plus run parameters."""
