"""Column functions: text and casts, scoring, report values."""
