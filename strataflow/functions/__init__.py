"""Column-level functions; every one returns a native Catalyst expression."""
