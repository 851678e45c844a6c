"""Column expressions: text standardising, numeric conversion, quality flags."""
