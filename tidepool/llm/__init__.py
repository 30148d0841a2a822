"""Operators for large training-data pipelines over documents, pages and vectors.

Nothing else in the library imports this subpackage. Each module holds one
operator; ``registry`` holds the registered queries and their SQL.
"""
