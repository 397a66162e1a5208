"""Column expressions: blank tests, name tokens, code repair, casts, hashes, similarity."""
