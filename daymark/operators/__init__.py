"""DataFrame operators. Each one takes DataFrames and parameters and returns a DataFrame."""
