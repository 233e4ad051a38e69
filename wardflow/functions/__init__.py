"""Column expressions and fixed values shared by batch and streaming code."""
