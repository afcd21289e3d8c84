"""Column expressions: rounding and exact sums, calendar, keys, costs, routing."""
