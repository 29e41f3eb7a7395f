"""Column helpers, number formatting and parameterised lookups."""
