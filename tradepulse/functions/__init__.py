"""Column builders and classification rules."""
