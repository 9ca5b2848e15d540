"""Column expressions: text, numbers, time."""
