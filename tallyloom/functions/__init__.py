"""Column functions: text, numbers, dates, known-ness, similarity."""
