"""Column-building helpers.  Each function maps Columns to a Column and
stays inside Spark's code generation (no Python UDFs)."""
