"""Column expressions: text, time and display rules."""
