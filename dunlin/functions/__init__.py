"""Column expressions for text, time and nested values."""
