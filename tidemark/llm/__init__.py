"""Operators of a training-data pipeline.

Nothing else in the library imports this subpackage.  Operators take a
DataFrame and column names, return a DataFrame, and state in their docstrings
what nulls, empty texts, ties and repeated rows give.
"""
