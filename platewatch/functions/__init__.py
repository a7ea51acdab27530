"""Column expressions: time, distance and speed."""
