"""Column expressions: text cleaning, order attributes, exact arithmetic."""
