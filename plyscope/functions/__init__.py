"""Column expressions: no action, no shuffle, no Python per row."""
