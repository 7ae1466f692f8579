"""Column-expression helpers: text, keys, vector arithmetic."""
