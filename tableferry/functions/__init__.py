"""Column types and text functions."""
