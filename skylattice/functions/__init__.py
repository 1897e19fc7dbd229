"""Column expressions and small fixed dimensions."""
