"""Reusable DataFrame operators: keys, joins, assignment and checks."""
