"""Column expressions and storage helpers."""
