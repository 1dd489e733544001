"""Operators of a training-data pipeline over text corpora.

Nothing outside this subpackage imports it; ``queries`` holds its registered queries.
"""
