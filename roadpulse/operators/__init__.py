"""Operators: DataFrame in, DataFrame out; batch and streaming unless noted."""
