"""Column expressions and distributed statistics used by the operators."""
