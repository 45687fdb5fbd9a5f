"""Column-expression helpers (built-in functions only, no UDFs)."""
