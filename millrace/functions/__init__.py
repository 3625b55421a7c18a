"""Column expressions: casts, names, sizes, hashes and partition transforms."""
