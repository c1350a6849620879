"""Column functions: text, dates, sentiment, taxonomy, nested values."""
