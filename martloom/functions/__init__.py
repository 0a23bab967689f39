"""Column expressions: calendar parts, rounding, safe ratios."""
