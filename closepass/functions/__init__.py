"""Column expressions: rounding, scoring, categorising, hash order, SQL function."""
