"""Column functions: calendar, text, identifiers and attributes."""
