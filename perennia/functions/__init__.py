"""Column expressions; all are built-in Catalyst expressions, none is a Python UDF."""
