"""Operators for large-scale training-data pipelines.

Nothing else in the library imports this package. Each module holds one operator with a general DataFrame interface;
``queries`` registers the thin ``opN_<name>`` queries and their SQL.
"""
