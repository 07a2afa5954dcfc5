"""Column expressions and column selectors."""
