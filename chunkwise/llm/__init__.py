"""Operators for training-data pipelines: filtering, near-duplicates, packing and search.

Nothing outside this package imports it. Each operator module has its own
public function on DataFrames; ``queries`` registers one query per operator.
"""
