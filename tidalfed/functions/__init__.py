"""Column functions: features, scores, vectors. All are built-in expressions."""
