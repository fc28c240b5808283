"""Operators for building training data out of documents and vectors.

Each module holds one operator with its own interface; ``queries`` has the thin
queries over the test tables. Nothing outside this package imports it.
"""
