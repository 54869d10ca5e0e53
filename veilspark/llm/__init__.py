"""Operators of a training-data pipeline: dedup, classifiers, mixing, licences, tokens.

Nothing else in the library imports this subpackage; it can be removed whole.
"""
