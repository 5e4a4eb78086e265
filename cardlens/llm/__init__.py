"""Operators of a training-data pipeline (documents, pages, conversations).

Nothing outside this subpackage imports it.  Each module holds one operator
with a general interface over DataFrames; ``queries`` binds them to the
given tables.
"""
