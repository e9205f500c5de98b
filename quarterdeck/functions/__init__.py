"""Column expressions: fiscal periods, ratios, text and JSON cells."""
