"""Operators for large training-data corpora (see ``queries.py`` for the registered queries)."""
