"""Operators of a training-data pipeline over the text tables.

Nothing else in the package imports this one; ``catalog`` registers its queries.
"""
