"""Operators over DataFrames: scoring, turns, alignment, joins, totals."""
