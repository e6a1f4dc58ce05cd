"""Column-expression helpers and fixed values."""
