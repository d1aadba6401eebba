"""Tamper-evident audit analytics on Spark DataFrames."""
