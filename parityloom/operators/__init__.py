"""Operators on DataFrames: profiles, divergences, joins, rules, sampling, raking, duplicates."""
