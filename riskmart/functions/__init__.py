"""Column expressions: text casts, seeded draws, and risk rules."""
