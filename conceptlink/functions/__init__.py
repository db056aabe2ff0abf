"""Column expressions: text, vectors, reproducible hashing."""
