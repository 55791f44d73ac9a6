"""Column-name helpers and scalar column expressions."""
