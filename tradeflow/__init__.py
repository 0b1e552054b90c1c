"""Market-trade feature, drift and decision analytics as plain Spark DataFrame functions."""
