"""Column functions: names, codes, numbers, similarity."""
