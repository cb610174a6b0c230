"""Column functions: numbers, text, dates, arrays and digests. All are built-in expressions."""
