"""Column expressions and small skew-safe building blocks."""
