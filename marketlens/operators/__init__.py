"""Reusable DataFrame operators: dedupe, rules, joins, ranks, percentiles, profiles."""
