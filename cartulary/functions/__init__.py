"""Column expressions: every rule that looks at one record only."""
