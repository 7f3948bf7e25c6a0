"""Operators: DataFrame in, DataFrame out, parameters as keyword arguments."""
