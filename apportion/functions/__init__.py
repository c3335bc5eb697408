"""Column-level helpers: filters, scalar functions, list functions, UDFs."""
