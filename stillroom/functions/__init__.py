"""Column expressions, all built from Catalyst built-ins."""
