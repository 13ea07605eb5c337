"""Column expressions: cleaning, calendar arithmetic, distance."""
