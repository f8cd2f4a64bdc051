"""Column expressions: text, numbers and bands."""
