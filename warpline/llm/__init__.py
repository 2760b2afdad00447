"""Operators for large-scale training-data pipelines.

Nothing outside this subpackage imports it.  Each operator has a module with a
general interface; ``queries.py`` holds the thin queries and their SQL.
"""
