"""Checks, joins, aggregates, windows and set operators over DataFrames."""
