"""Column expressions and one-step projections."""
