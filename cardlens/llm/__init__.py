"""Operators for preparing text and vectors for model training.

Nothing outside this package imports it.
"""
