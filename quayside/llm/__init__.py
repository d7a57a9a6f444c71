"""Operators of a training-data pipeline over the `documents` tables.

Nothing else in the package imports this subpackage.
"""
