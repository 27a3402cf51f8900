"""Column helpers: names and type-text classification."""
