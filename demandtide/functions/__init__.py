"""Column expressions: calendar arithmetic, text and number cleaning."""
