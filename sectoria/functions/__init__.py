"""Column functions: every one builds a Catalyst expression."""
