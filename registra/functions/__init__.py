"""Column expressions: dates, text, geo and keys."""
