"""Column-to-column expressions."""
