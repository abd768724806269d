"""Operators of a training-data pipeline over a table of documents.

Nothing else in the library imports this subpackage. Every operator takes and
returns DataFrames; ``queries.py`` registers one query for each."""
