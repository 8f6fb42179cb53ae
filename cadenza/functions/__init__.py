"""Column expressions (Catalyst) and the few vectorised Python helpers."""
