"""Operators: DataFrame in, DataFrame or fitted step out."""
