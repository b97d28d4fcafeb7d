"""Column expressions and column roles."""
