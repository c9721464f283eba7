"""Column expressions. Everything here returns a Column built from built-in functions."""
