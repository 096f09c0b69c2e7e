"""Column builders: pure expressions, no data movement."""
