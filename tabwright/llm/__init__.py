"""Operators for training-data pipelines over text tables, and their registered queries."""
