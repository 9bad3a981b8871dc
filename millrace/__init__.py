"""Batch analytics on Spark: parameterised DataFrame operators and end-to-end plans."""
