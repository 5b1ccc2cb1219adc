"""Column expressions: hashing, text normalisation, redaction, JSON lines."""
