"""Column expressions: keys, time, and health formulas."""
