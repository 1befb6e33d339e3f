"""DataFrame operators. Each takes and returns a DataFrame."""
