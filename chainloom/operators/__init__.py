"""Relational operators: shredding, joins, aggregates, windows, reports and write semantics."""
