"""Operators of a training-data pipeline over text tables.

Nothing else in the library imports this subpackage; it only borrows the
session helpers. Every operator takes DataFrames and column names, selects the
columns it needs (so extra columns, whatever their names, never clash) and
documents what it does with nulls, empty texts, ties and repeated rows.
"""
