"""Column functions: pure expressions, no Python code at run time."""
