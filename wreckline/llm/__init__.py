"""Operators for preparing training data: one module per operator, each a plain
``DataFrame -> DataFrame`` function, plus ``registry`` with the queries that apply them."""
