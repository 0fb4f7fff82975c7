"""Operators for building language-model training data from document tables.

Nothing outside this package imports it; ``queries.py`` binds the operators to
the driver tables.
"""
