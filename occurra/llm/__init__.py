"""Operators of a training-data pipeline: text, vectors and web records.

Nothing else in the library imports this subpackage.
"""
