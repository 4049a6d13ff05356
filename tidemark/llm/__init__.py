"""Operators of a training-data pipeline: text, URL, media and language-model work on Spark tables.

Nothing else in the library imports this subpackage.
"""
