"""Column expressions and the distributed ordering helpers."""
