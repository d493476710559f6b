"""Column builders: hashing, dates, text, atoms."""
