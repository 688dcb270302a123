"""Operators of a training-data pipeline.

Each module holds one operator with a general interface; ``catalog`` holds the
registered queries.  Nothing else in the package imports this subpackage.
"""
