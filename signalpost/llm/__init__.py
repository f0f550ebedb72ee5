"""Operators for preparing training text: one module per operator, all reading plain DataFrames.

Every operator takes the names of its key and text columns, looks at no other column, and returns a new
table; columns of the input with other names never clash with its own.
"""
