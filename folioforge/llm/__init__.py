"""Operators of a training-data pipeline over web-scale text (documents, pages).

Nothing outside this package imports it; ``queries.py`` registers its queries.
"""
