"""Column builders: text, numbers, bands, calendar."""
