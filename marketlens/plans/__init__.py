"""Whole jobs: cleaning, quality, views, business queries, evidence, measures."""
