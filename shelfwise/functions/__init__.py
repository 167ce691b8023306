"""Column expressions: built-in functions only, safe on null, NaN and empty."""
