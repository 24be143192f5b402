"""Operators for large training-corpus pipelines.

Nothing else in the library imports this subpackage.  Each module holds one
operator; ``registry`` lists the queries that apply them to the given tables.
"""
