"""Column functions and the predicate language."""
