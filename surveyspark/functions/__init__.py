"""Column helpers: missing-value rules, labels, reshaping, statistics."""
