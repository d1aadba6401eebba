"""Operators for preparing large text corpora on Spark.

Nothing outside this subpackage imports it; it can be removed as a whole.
"""
