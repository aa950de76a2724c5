"""Column expressions: coercion, names and locations, HTML cells, scores."""
