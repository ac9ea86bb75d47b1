"""Relational operators: aggregations, joins, reach, windows, rankings, Bayes."""
