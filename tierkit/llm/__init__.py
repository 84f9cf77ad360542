"""Operators of a training-data pipeline over document tables.

Nothing else in the library imports this package.  Each module holds one
operator with its own interface; :mod:`tierkit.llm.queries` registers one
query per operator.
"""
