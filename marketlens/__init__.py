"""Marketplace analytics on Spark: clean, conform, audit and measure two-grain data."""
