"""Column expressions: no job is started by anything in this package."""
