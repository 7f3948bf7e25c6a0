"""Column functions on sequences, and shared helpers."""
