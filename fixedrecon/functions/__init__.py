"""Column expressions: text slicing, picture clauses and field comparison."""
