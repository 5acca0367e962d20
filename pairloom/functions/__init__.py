"""Column expressions: no function here causes a shuffle."""
