"""Column functions: text, code scoring, vectors."""
