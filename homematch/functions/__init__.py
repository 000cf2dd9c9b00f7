"""Column functions: text, dates, numbers and arrays."""
