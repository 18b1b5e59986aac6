"""Operators for training text: filters, joins, mixing and output, with their queries."""
