"""Operators for preparing large text corpora, built on Spark DataFrames.

Nothing outside this subpackage imports it; ``registry`` lists its queries.
"""
