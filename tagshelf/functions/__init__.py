"""Column functions: coercion, exact numerics, map and array predicates."""
