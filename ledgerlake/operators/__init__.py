"""Reusable DataFrame operators: JSON flattening, latest-wins, surrogate keys, joins, aggregates, marks."""
