"""Operators for building training data from web text.

Each module holds one operator (general function over DataFrames) and the
thin query the repository registers for it; ``registry`` lists the queries
and their SQL. Nothing else in the library imports this package.
"""
