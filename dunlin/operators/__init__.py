"""Relational operators: row order, joins, profiling, neighbours, density."""
