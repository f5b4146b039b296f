"""Column expressions: text, numbers, arrays and maps."""
